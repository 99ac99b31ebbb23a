import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import line_dedup, simhash
from tidegate.llm.common import connected, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def print_by_force(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_force(prints, linked):
    """Smallest key reachable from each key of ``prints``."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(keys, 2):
        if linked(prints[a], prints[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("radius, parts", [(1, 1), (3, 1), (5, 2), (9, 2)])
def test_every_pair_in_the_radius_shares_a_mask(radius, parts):
    masks = simhash.masks(radius, parts)
    assert len(masks) == parts * (2 ** (radius // parts + 1) - 1)
    if radius <= 3:
        differences = [sum(1 << i for i in c) for r in range(radius + 1) for c in itertools.combinations(range(64), r)]
    else:
        rng = np.random.default_rng(1)
        differences = [sum(1 << int(i) for i in rng.choice(64, radius, False)) for _ in range(20_000)]
    left = np.array(differences, np.uint64)
    for m in masks:
        left = left[(left & np.uint64(m)) != 0]
    assert not len(left)


@pytest.mark.parametrize("block, words", [(2_048, 1), (8, 1), (2_048, 2)])
def test_components_equal_brute_force(spark, block, words, monkeypatch):
    rng = np.random.default_rng(words)
    base = rng.integers(0, 2**63, (12, words)).astype(np.uint64)
    prints = {}
    for i in range(400):
        own = base[i % 12].copy()
        for bit in rng.choice(64, rng.integers(0, 6), replace=False):
            own[rng.integers(0, words)] ^= np.uint64(1) << np.uint64(bit)
        prints[i] = tuple(int(x) for x in own)
    prints |= {400 + i: prints[i] for i in range(30)}  # copies
    rows = [(k, *(x - 2**64 if x >= 2**63 else x for x in v)) for k, v in prints.items()]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long", *(f"{n} long" for n in simhash.NAMES[:words])]))
    monkeypatch.setattr(simhash, "SAMPLE", 2)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash.links, "__defaults__", (1, 128, block))
    got = {r.doc_id: r.component_id for r in simhash.grouped(df, 3, 1, 5).collect()}
    bits = lambda a, b: [(x ^ y).bit_count() for x, y in zip(a, b)]
    limit = 5 if words == 2 else 3
    want = groups_by_force(prints, lambda a, b: bits(a, b)[0] <= 3 and sum(bits(a, b)) <= limit)
    assert got == want


def test_simhash_of_odd_documents(spark, odd, none):
    got = simhash.report(odd).collect()
    rows = odd.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted(
        (str(r.doc_id), f"{print_by_force(r.text):016x}") for r in rows
    )
    named = {r.doc_id: r.component_id for r in got}
    assert named[3] == named[4] == named[5] == 3  # null, empty and blank texts
    assert named[8] == named[9] == 8 and named[None] is None
    assert simhash.report(none).count() == 0
    kept = simhash.one_of_each_group(odd)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 6, 7, 8, 8, 10] and kept.columns == odd.columns
    assert kept.where("doc_id is null").count() == 1
    assert simhash.one_of_each_group(none).count() == 0


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(600)]
    texts = [" ".join(rng.choice(words, 300)) for _ in range(40)]
    copies = [t.replace(" ", "  ", 3).upper() for t in texts[:10]]
    near = []
    for t in texts[10:30]:
        own = t.split()
        own[150] = "changed"
        near.append(" ".join(own))
    rows = list(enumerate(texts + copies + near))
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(40)) <= ids and not ids & set(range(40, 50)) and len(ids & set(range(50, 70))) <= 1


def test_connected_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000), (-7, 5001)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)} | {-7: -7, 5001: -7}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(text):
    for number, line in enumerate((text or "").split("\n")):
        own = frozenset(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.translate(LOWER)))
        if own:
            yield number, own


def removed_by_force(docs):
    """Lines with an earlier line of Jaccard similarity 0.8 or more; documents have distinct ids and come in order."""
    seen, out = [], set()
    for doc_id, text in docs:
        for number, own in sets_of(text):
            if any(10 * len(own & s) >= 8 * len(own | s) for s in seen):
                out.add((doc_id, number))
            seen.append(own)
    return out


@pytest.mark.parametrize("frequent, few", [(2, 4), (8, 0), (1_000, 4), (1_000, 0)])
def test_line_dedup_equals_brute_force(spark, frequent, few):
    rng = np.random.default_rng(frequent)
    words = [f"w{i}" for i in range(60)]
    rare = iter(range(10_000))
    docs = []
    lines = []
    for i in range(120):
        own = []
        for _ in range(rng.integers(1, 6)):
            if lines and rng.random() < 0.5:
                line = list(lines[rng.integers(len(lines))])
                for _ in range(rng.integers(0, 4)):
                    line[rng.integers(len(line))] = f"x{next(rare)}" if rng.random() < 0.5 else str(rng.choice(words))
            else:
                line = [str(w) for w in rng.choice(words, rng.integers(1, 30))]
            lines.append(line)
            own.append(" ".join(line))
        docs.append((i, "\n".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {(r.doc_id, r.number) for r in line_dedup.removed_lines(df, frequent, few).collect()}
    assert got == removed_by_force(docs) and len(got) > 50


def test_lines_of_a_template_are_dealt_in_blocks(spark, monkeypatch):
    """Lines that share their frequent words make one key; no group that a task compares may hold them all."""
    rng = np.random.default_rng(9)
    often = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join([*often, *(f"v{rng.integers(150)}x{k}" for k in range(2))])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(line_dedup, "BLOCK", 50)
    monkeypatch.setattr(line_dedup, "SAMPLE", 1)
    dealt, groups = line_dedup._in_blocks, []

    def counted(index, sample):
        out = dealt(index, sample)
        whole = index.groupBy(F.shiftright("key", 32)).agg(F.count_distinct("line").alias("n")).agg(F.max("n")).first()[0]
        most = out.groupBy(F.shiftright("key", 32)).agg(F.count_distinct("line").alias("n")).agg(F.max("n")).first()[0]
        groups.append((whole, most))
        return out

    monkeypatch.setattr(line_dedup, "_in_blocks", counted)
    got = {(r.doc_id, r.number) for r in line_dedup.removed_lines(df, 8, 2).collect()}
    assert got == removed_by_force(docs) and len(got) > 50
    assert groups[0][0] > 300 and groups[0][1] < 200


def test_keys_of_a_very_long_line_come_in_slices(monkeypatch):
    monkeypatch.setattr(line_dedup, "KEY_ROWS", 1_000)
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**63, 2_000).astype(np.uint64))
    counts = np.full(1 << line_dedup.BUCKET_BITS, 9)
    order_of = np.arange(len(counts), dtype=np.uint64)
    parts = list(line_dedup._keys_of(np.array([2_000]), hashes, counts, order_of, 8))
    assert max(len(p[0]) for p in parts) <= 2_000 and sum(len(p[0]) for p in parts) == 402 * 401 // 2


@pytest.mark.parametrize("size", [40, 1_000, 10**6])
def test_lines_of_a_slice_equal_single_lines(size, monkeypatch):
    """Rows, numbers and word counts of lines; equal word sets have equal digests, different ones different."""
    monkeypatch.setattr(line_dedup, "SLICE", size)
    rng = np.random.default_rng(size)
    letters = list("aAbB19") + ["\u00e9", "\u4e2d", "_", "\t", "\r", " ", " "]
    word = lambda: "".join(rng.choice(letters, rng.integers(1, 40)))
    texts = [None, "", "\n", "\n\nx"] + [
        "\n".join(" ".join(word() for _ in range(rng.integers(0, 4))) for _ in range(rng.integers(0, 9))) for _ in range(150)
    ]
    texts += ["A b\nb a B\nb", "0123456789abcdef 01234567 0123456789abcdefg 012345678\n0123456789abcdef"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    got, digests = [], {}
    for lines in filter(None, map(line_dedup._lines, line_dedup._parts(batch))):
        assert lines.size.sum() == len(lines.hashes)
        for row, number, n, one, two in zip(*(x.tolist() for x in lines[:5]), strict=True):
            own = dict(sets_of(texts[row]))[number]
            assert len(own) == n and digests.setdefault(own, (one, two)) == (one, two)
            got.append((row, number))
    assert got == [(i, number) for i, text in enumerate(texts) for number, _ in sets_of(text)]
    assert len(set(digests.values())) == len(digests) == len({one for one, _ in digests.values()}) > 300


def test_lines_of_one_long_document_and_of_equal_ids(spark, monkeypatch):
    """Template lines inside one document count in the sample of lines; texts that share an id have an order too."""
    rng = np.random.default_rng(5)
    often = [f"w{i}" for i in range(12)]
    template = lambda: " ".join([*often, *(f"v{rng.integers(90)}x{k}" for k in range(2))])
    long = "\n".join(template() for _ in range(300))
    docs = [(1, long), *((2 + i, template()) for i in range(100))]
    monkeypatch.setattr(line_dedup, "BLOCK", 50)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.number) for r in line_dedup.removed_lines(df, 8, 2).collect()}
    assert got == removed_by_force(docs) and len(got) > 50
    same = [(7, template()) for _ in range(120)]
    rows = line_dedup._keyed(spark.createDataFrame(same, "doc_id long, text string")).distinct().orderBy("text_key").collect()
    want = {rows[i].text_key for i, _ in removed_by_force([(i, r.text) for i, r in enumerate(rows)])}
    df = spark.createDataFrame(same, "doc_id long, text string").repartition(3)
    got = {r.text_key for r in line_dedup.removed_lines(df, 8, 0).collect()}
    assert got == want and want


def test_lines_of_tables(spark, small):
    docs = table(spark, small, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    gone = removed_by_force(rows)
    want = {}
    for doc_id, text in rows:
        lines = text.split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if (doc_id, i) not in gone)
        want[doc_id] = (len(lines), sum(d == doc_id for d, _ in gone), hashlib.sha256(kept.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in line_dedup.report(docs).collect()} == want


def test_lines_of_odd_documents(spark, odd, none):
    got = line_dedup.deduplicated(odd)
    assert odd.columns == got.columns and got.count() == odd.count()
    texts = {}
    for r in got.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[3] == [None] and texts[4] == [""] and texts[5] == ["   \n\t "]
    assert texts[2] == ["Another line; quite its own words."]  # its first line has the words of document 1's
    assert texts[8] == ["twice the same row"] * 2 and texts[9] == [""]  # equal rows are one document
    assert line_dedup.deduplicated(none).count() == 0
    counted = line_dedup.deduplicated(odd.select("doc_id", "text", F.lit(0).cast("int").alias("n_chars")))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in counted.collect())


def test_one_of_each_group_of_tables(spark, small):
    docs = table(spark, small, "documents")
    prints = {r.doc_id: print_by_force(r.text) for r in docs.collect()}
    groups = groups_by_force(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert {r.doc_id for r in simhash.one_of_each_group(docs).collect()} == set(groups.values())


def test_one_of_each_group_passes_columns_of_any_name(spark, odd):
    named = odd.select("doc_id", "text", F.lit(1).alias("kept_id"), F.lit(2).alias("a.b"), F.lit(3).alias("component_id"))
    got = simhash.one_of_each_group(named)
    assert got.columns == named.columns
    rows = got.select("doc_id", "text", "kept_id", "`a.b`").collect()
    assert {r["kept_id"] for r in rows} == {1} and {r["a.b"] for r in rows} == {2}
    # Texts without words are one group, equal texts another; rows that share an id are one document.
    assert sorted(r.doc_id for r in rows if r.doc_id in (3, 4, 5, 8, 9)) == [3, 8, 8]


def test_kept_ids_meet_the_documents_by_a_shuffle(spark):
    """The kept ids grow with the documents, so even a few of them are not broadcast through the driver."""
    docs = spark.createDataFrame([(n, f"text number {n} of its own") for n in range(20)], "doc_id long, text string")
    got = simhash.one_of_each_group(docs)
    assert {r.doc_id for r in got.collect()} == set(range(20))
    plan = got._jdf.queryExecution().executedPlan().toString()
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("SortMergeJoin" in line for line in semi), plan
