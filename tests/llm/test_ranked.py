import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import compare, connect
from tidegate.llm import ranked
from tidegate.llm.oracle import ORACLE
from tidegate.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_force(docs, items, depth):
    bags = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    many, total = len(bags), sum(sum(b.values()) for _, b in bags)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in wanted.items():
        df = {w: sum(w in b for _, b in bags) for w in words}
        weight = {w: math.floor(1000 * math.log((2 * many + 2) / (2 * n + 1))) for w, n in df.items()}
        scores = []
        for doc, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * many) // total
            score = sum(weight[w] * (1_000_000_000 * bag[w] // (1_000 * bag[w] + 20 * m)) for w in words if w in bag)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(scores)[:depth], 1):
            out.append((item, rank, None if missing else doc, -score))
    return sorted(out, key=lambda r: (r[0], r[1]))


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (r[0], r[1]))


def test_against_sql(spark, small):
    problems = compare(spark, connect(small), QUERIES["op12_ranked_search"], ORACLE["op12_ranked_search"], small)
    assert [p for p in problems if not p.startswith("plan leaves")] == []


@pytest.fixture(scope="module")
def made():
    """Many copies and ties: few words, short texts, a third of all documents the same."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)] + ["Éa", "日本", "X9"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 6)))) for i in range(400)]
    docs += [(1_000 + i, "w1 w2, w3! w1") for i in range(200)]
    rng.shuffle(docs)
    docs = [(int(i), str(t)) for i, t in docs]
    items = [(i, " ".join(rng.choice(words, 4))) for i in range(12)] + [(50, "w1"), (51, "nowhere"), (52, "")]
    return docs, items


@pytest.mark.parametrize("depth, block", [(50, 50_000), (3, 7), (700, 50_000)])
def test_against_brute_force(spark, made, depth, block):
    docs, items = made
    got = ranked.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"), depth, block,
    )
    assert found(got) == by_force(docs, items, depth)


def test_small_blocks_give_the_same(spark, made, monkeypatch):
    docs, items = made
    monkeypatch.setattr(ranked, "CELLS", 64)
    bags = [(ranked.np.array([[0, 2], [3, 1]], "<u4").tobytes(), 60, [4, 9]), (np.array([[3, 5]], "<u4").tobytes(), 55, [1])]
    batch = ranked.pa.RecordBatch.from_arrays(
        [ranked.pa.array(c) for c in zip(*bags, strict=True)], names=["bag", "m", "members"]
    )
    weights = {k: np.array(v, np.int64) for k, v in {"term": [0, 3, 3], "item": [0, 0, 1], "weight": [10, 7, 7]}.items()}
    rows = [r for b in ranked._score_step(weights, 2, 5)([batch]) for r in b.to_pylist()]

    def score(tf, m):
        return 1_000_000_000 * tf // (1_000 * tf + 20 * m)

    want = {(0, 10 * score(2, 60) + 7 * score(1, 60)), (0, 7 * score(5, 55)), (1, 7 * score(1, 60)), (1, 7 * score(5, 55))}
    assert {(r["place"], r["score"]) for r in rows} == want
    monkeypatch.setattr(ranked, "EXACT", 1)  # whole numbers in place of doubles
    again = [r for b in ranked._score_step(weights, 2, 5)([batch]) for r in b.to_pylist()]
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_equal_bags_are_one_class(spark, made):
    docs, _ = made
    names = sorted({t.encode() for _, text in docs for t in terms(text)})
    counted = ranked.bags(spark.createDataFrame(docs, "doc_id long, text string"), names)
    got = ranked.classes(counted, 600, 2_000, 50).collect()
    assert len({(bytes(r.bag), r.m) for r in got}) == len(got)
    hot = max(got, key=lambda r: len(r.members))
    assert hot.members == sorted(d for d, t in docs if sorted(terms(t)) == ["w1", "w1", "w2", "w3"])[:50]


def test_long_texts_in_pieces(monkeypatch):
    text = ("Alpha beta-GAMMA 12é. " * 500).encode()
    whole = [w for p in ranked.terms_of(text) for w in p]
    monkeypatch.setattr(ranked, "PIECE", 37)
    assert [w for p in ranked.terms_of(text) for w in p] == whole == [t.encode() for t in terms(text.decode())]
    assert list(ranked.terms_of(None)) == []


def test_odd_tables(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "words TWICE", "x"), (1, "same", "x"), (None, "words", "x"), (2, None, "x"), (3, "alpha id 日本語", "x")],
        "item_id long, text string, term string",
    )
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    pairs = [tuple(r)[:2] for r in items.collect()]
    assert found(ranked.search(odd, items)) == by_force(docs, pairs, 50)
    assert ranked.search(none, items).collect() == [] and ranked.search(odd, items.limit(0)).collect() == []
    named = spark.createDataFrame([("q", "twice")], "item_id string, text string")
    assert {r.item_id for r in ranked.search(odd.withColumn("doc_id", F.col("doc_id").cast("int")), named).collect()} == {"q"}
