import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_filters import base_by_force
from tidegate.llm import licenses, pii, scans


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 512, 5000])
def test_running_values(spark, n):
    values = np.random.default_rng(n).integers(-9, 9, n).tolist()
    df = spark.createDataFrame([(values,)], "v array<int>")
    add = scans.running(F.col("v"), F.lit(0), lambda x, y: x + y)
    top = scans.running(F.col("v"), F.lit(-100), F.greatest)
    row = df.select(add.alias("add"), top.alias("top")).first()
    assert row["add"] == [sum(values[:i]) for i in range(n)]
    assert row.top == [max([-100, *values[:i]]) for i in range(n)]


def test_parts_of_chunks(spark):
    text = "".join(chr(0x1F600 + i % 40) if i % 7 == 0 else chr(97 + i % 26) for i in range(2000))
    cuts = [(0, 0), (0, 1), (0, 2000), (511, 513), (512, 1024), (700, 700), (1999, 2000), (2000, 2001), (900, 800)]
    df = spark.createDataFrame([(text, a, b) for a, b in cuts], "t string, a int, b int")
    got = df.select("a", "b", scans.part_of(scans.chunks_of(F.col("t")), F.col("a"), F.col("b")).alias("x")).collect()
    assert all(r.x == text[r.a : r.b] for r in got)


def within(spans):
    """Spans that no other contains; of equal ones the best."""
    rank = lambda s: (s[2] - s[1], s[3], s[0])
    return {s[:3] for s in spans if not any(q[1] <= s[1] and s[2] <= q[2] and rank(q) > rank(s) for q in spans)}


def test_outermost_spans_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for n in (0, 1, 5, 40, 700):
        start = rng.integers(0, 3 * n + 1, n)
        made = zip(rng.choice(pii.KINDS, n).tolist(), start.tolist(), (start + rng.integers(1, 9, n)).tolist(), rng.integers(0, 3, n) / 2, strict=True)
        base = [(k, a, b) for k, a, b, _ in list(zip(rng.choice(pii.KINDS, n // 9).tolist(), start.tolist(), (start + 4).tolist(), start.tolist()))]
        rows.append(([(k, a, b, float(s)) for k, a, b, s in made], base))
    kind = "chosen array<struct<kind:string,start:int,stop:int,score:double>>, base array<struct<kind:string,start:int,stop:int>>"
    got = spark.createDataFrame(rows, kind).select("*", pii.outermost("chosen").alias("x"), pii.outermost("chosen", "base").alias("y"))
    for r in got.collect():
        spans = [tuple(s) for s in r.chosen]
        assert sorted(map(tuple, r.x)) == sorted(within(spans))
        outside = [s for s in spans if not any(b.start <= s[1] and s[2] <= b.stop for b in r.base)]
        assert sorted(map(tuple, r.y)) == sorted(within(outside))


def test_very_many_spans_in_one_text(spark):
    text = " ".join(f"u{i}@ex.org" for i in range(80_000))
    docs = spark.createDataFrame([(1, text), (2, "nothing")], "doc_id long, text string")
    begin = time.time()
    row = pii.report(docs).where("doc_id = 1").first()
    assert row.n_email == 80_000 and row.spans.split(",") == base_by_force(text)
    redacted = pii.redacted(docs).where("doc_id = 1").first().text
    assert redacted == " ".join(["[email]"] * 80_000)
    assert time.time() - begin < 120


def test_very_many_licences_in_one_text(spark):
    # Two rules of one sentence: all spans are apart, so none leaves any other out.
    text = "All rights reserved. Released under the MIT License.\n\nfoo bar. " * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.time()
    row = licenses.recognise(docs, licenses.sentence_frame(spark), licenses.rule_frame(spark)).first()
    assert row.licences == ["MIT", "proprietary"] and row.n_sentences == 40_000
    assert time.time() - begin < 120


def test_longest_spans_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    start = rng.integers(0, 900, 600)
    held = list({((int(a), int(a + n)), f"L{x}") for a, n, x in zip(start, rng.integers(1, 6, 600), rng.integers(0, 600, 600), strict=True)})
    df = spark.createDataFrame([(held,)], "held array<struct<span:struct<start:int,stop:int>,licence:string>>")
    got = df.select(licenses._longest(F.col("held")).alias("x")).first().x
    inside = lambda s: any(q[0] <= s[0] and s[1] <= q[1] and q != s for q, _ in held)
    assert sorted(r.licence for r in got) == sorted(x for s, x in held if not inside(s))


def test_thresholds_are_judged_out_of_fold():
    # One mark for each fold: what the trees learn of the others says nothing of it.
    counts = [(k, (0, k), 100, 100 * (k % 2)) for k in range(4)]
    trees, limits = pii.calibrated(counts, 0.9)
    assert pii.thresholds([(x, n, y) for _, x, n, y in counts], trees, 0.9) == {"email": pytest.approx(min(pii.value_of(trees, (0, k)) for k in (1, 3)), abs=1e-4)}
    seen_apart = [(k, (0, 1), 100, 95) for k in range(4)]
    assert set(pii.calibrated(seen_apart, 0.9)[1]) == {"email"}
    assert limits != pii.thresholds([(x, n, y) for _, x, n, y in counts], trees, 0.9)
    assert pii.calibrated([]) == ([], {})
