import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import topk, url_filter


def best_by_force(vectors, k, queries):
    out = set()
    for q in queries:
        scores = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("shard_rows", [7, 64, 5000])
def test_topk_equals_brute_force(spark, shard_rows):
    rng = np.random.default_rng(3)
    vectors = {i: rng.integers(-40, 40, 12) for i in range(300)}
    vectors |= {i: vectors[i - 300] for i in range(300, 330)}  # ties
    items = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, terms array<long>")
    found = topk.top_k(items, items.where("vec_id % 17 = 0"), 5, shard_rows)
    assert {tuple(r) for r in found.collect()} == best_by_force(vectors, 5, range(0, 330, 17))


def test_topk_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [0.25, -1.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0])]
    rows += [(5, [0.5]), (6, [1.0, 0.5]), (6, [1.0, 0.5]), (None, [1.0, 1.0]), (100, [nan])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.report(df).collect()}
    vectors = {0: [256, 128], 50: [64, -256], 5: [128, 0], 6: [256, 128]}
    assert got == best_by_force(vectors, 5, [0, 50])
    assert topk.report(df.limit(0)).count() == 0
    assert topk.report(df.where("vec_id = 0")).count() == 0  # no candidate but itself


def test_topk_very_large_terms(spark):
    vectors = {i: [2**40 + i, -(2**20) * i] for i in range(40)}
    items = spark.createDataFrame(list(vectors.items()), "vec_id long, terms array<long>")
    small = items.select("vec_id", F.transform("terms", lambda t: (t % 2**29).cast("long")).alias("terms"))
    exact = {r.vec_id: r.terms for r in small.collect()}
    got = {tuple(r) for r in topk.top_k(small, small.where("vec_id < 3"), 4, 8).collect()}
    assert got == best_by_force(exact, 4, [0, 1, 2])


URLS = [
    (1, "https://WWW.Example.com/en/x?y=1", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (2, "http://blog.example.com/en/1#top", "blog.example.com", "/en/1", "example.com/en/", "block"),
    (3, "http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
    (4, "http://a.net/es", "a.net", "/es", None, "allow"),
    (5, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    (6, "example.com/en/", "", "", None, "allow"),
    (7, None, "", "", None, "allow"),
    (8, "", "", "", None, "allow"),
    (9, "x://", "", "", None, "allow"),
    (10, "http://com", "com", "", None, "allow"),
    (11, "a://b://net/fr/x", "b:", "//net/fr/x", None, "allow"),
    (11, "a://net/fr/x", "net", "/fr/x", "net/fr/", "block"),
    (None, "a://net/fr/x", "net", "/fr/x", "net/fr/", "block"),
    (12, "a://net/fr/" + "p" * 50_000, "net", "/fr/" + "p" * 50_000, "net/fr/", "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([r[:2] for r in URLS], "page_id long, url string")
    clash = pages.withColumn("host", F.lit("h")).withColumn("verdict", F.lit("v"))
    got = url_filter.judge(clash, url_filter.rule_frame(spark)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *r[2:]) for r in URLS), key=key)


def test_url_rules_of_any_length_and_ties(spark):
    rules = [("x.org", "/ab", "block"), ("org", "/abcd", "allow"), ("x.org", "", "allow"), ("y.org", "/", None)]
    rules += [("z.org", "/", "allow"), ("z.org", "/", "block"), (None, "/", "block")]
    pages = spark.createDataFrame([(1, "a://x.org/abcde"), (2, "a://y.org/"), (3, "a://z.org/"), (4, "a://x.org")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rule_frame(spark, rules)).collect()}
    assert got == {1: ("x.org/ab", "block"), 2: (None, "allow"), 3: ("z.org/", "block"), 4: ("x.org", "allow")}
    assert url_filter.judge(pages.limit(0), url_filter.rule_frame(spark)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, url_filter.rule_frame(spark).limit(0)).collect()} == {"allow"}
