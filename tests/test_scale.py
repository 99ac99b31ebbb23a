"""Operators that avoid single-task groups, against brute force, with the layout forced to its large form."""

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.operators import keys, neighbours, skew
from tidegate.operators.neighbours import slot_bounds, with_neighbour
from tidegate.operators.quantile import exact_quantile
from tidegate.session import written

LARGE = {"rows_per_group": 20, "broadcast_bytes": 0}


@pytest.fixture(scope="module")
def work(spark):
    """A third of the rows share a key, a sixth have none, some have a blank division."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        share = rng.random()
        key = "hot" if share < 0.33 else None if share < 0.5 else f"k{rng.randrange(1500)}"
        rows.append((i, key, rng.choice(["U", "U", "U", "D", "", None])))
    return spark.createDataFrame(rows, "i int, k string, process_div string").repartition(6).persist()


def expected_duplicates(work):
    rows = work.collect()
    live = Counter(r["k"] for r in rows if r["process_div"])
    return sorted(r["i"] for r in rows if r["k"] is not None and live[r["k"]] > 1)


@pytest.mark.parametrize("layout", [{}, LARGE])
def test_duplicates(spark, work, layout):
    found = keys.rows_with_duplicate_key(work, ["k"], **layout)
    assert sorted(r["i"] for r in found.collect()) == expected_duplicates(work)


def test_full_copies_are_dealt_out(spark):
    copies = spark.range(4000).repartition(8).select(F.lit("same").alias("k"), F.lit("U").alias("process_div"))
    counted = keys.with_duplicate_count(copies, ["k"], rows_per_group=500, broadcast_bytes=0)
    assert [r[0] for r in counted.select("row_cnt").distinct().collect()] == [4000]
    assert counted.count() == 4000
    hot = skew.hot_keys(spark.createDataFrame([("same", 4000)], "k string, n long"), ["k"], "n", 500)
    dealt = skew._with_groups(copies, hot, ["k"])
    group = F.pmod(F.xxhash64(F.spark_partition_id(), "k", "process_div"), F.col("__groups"))
    assert dealt.select(group).distinct().count() > 1


def test_every_hot_key_is_dealt_out(spark):
    counts = spark.range(30_000).select(F.repeat(F.col("id").cast("string"), F.lit(500)).alias("k"), (F.col("id") + 1).alias("n"))
    hot = skew.hot_keys(counts, ["k"], "n", 50)
    assert hot.count() == 30_000 - 50 and hot.columns == ["__hash", "__groups"]


def test_empty_lookup(spark, work):
    none = work.where("k = 'never'")
    marked = keys.with_duplicate_count(work, ["k"], counted=none)
    assert marked.where("row_cnt is not null").isEmpty() and marked.count() == work.count()


@pytest.mark.parametrize("layout", [{}, LARGE])
def test_flag_by_row_id(spark, work, layout):
    rows = work.withColumn("error_flg", F.lit(False))
    ids = spark.createDataFrame([(i,) for i in range(0, 3000, 7)] * 2, "i int")
    flagged = keys.flag_by_row_id(rows, ids, "i", **layout)
    assert sorted(r["i"] for r in flagged.where("error_flg").collect()) == list(range(0, 3000, 7))
    assert flagged.count() == 3000


def brute_neighbours(rows, following):
    best = {}
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or datetime.min, r[0]), reverse=following)
    found = {}
    for i, k, t, v in order:
        found[i] = best.get(k)
        if v is not None:
            best[k] = v
    return found


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("rows_per_slot", [10_000, 100, 7])
def test_neighbours(spark, following, rows_per_slot):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(1200):
        k = "hot" if rng.random() < 0.4 else None if rng.random() < 0.1 else f"k{rng.randrange(40)}"
        t = start + timedelta(seconds=rng.randrange(600) if rng.random() < 0.8 else 300)
        t = None if rng.random() < 0.05 else t
        rows.append((i, k, t, rng.choice([None, i, i])))
    frame = spark.createDataFrame(rows, "i int, k string, t timestamp_ntz, v int").repartition(5)
    found = with_neighbour(frame, ["k"], "t", ["i"], F.col("v"), "near", following, rows_per_slot)
    assert {r["i"]: r["near"] for r in found.collect()} == brute_neighbours(rows, following)


def test_one_moment_holds_most_rows(spark, monkeypatch):
    ranged = []
    monkeypatch.setattr(neighbours, "written", lambda df, name: ranged.append(name) or written(df, name))
    moment = datetime(2024, 1, 1)
    rows = [(i, "hot" if i % 3 else "other", moment if i % 5 else moment + timedelta(seconds=i), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "i int, k string, t timestamp_ntz, v int").repartition(7)
    for following in (False, True):
        found = with_neighbour(frame, ["k"], "t", ["i"], F.col("v"), "near", following, 20)
        assert {r["i"]: r["near"] for r in found.collect()} == brute_neighbours(rows, following)
    assert ranged == ["ranges", "ranges"]


def test_slots_follow_the_data(spark):
    frame = spark.range(1000).select((F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("t"))
    bounds = slot_bounds(frame, "t", 10)
    assert len(bounds) == 9 and bounds == sorted(bounds)


@pytest.mark.parametrize("limit", [1_000_000, 50])
@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("shape", ["even", "hot", "few", "steep"])
def test_quantile(spark, limit, share, shape):
    rng = np.random.default_rng(5)
    values = {
        "even": rng.random(3000),
        "hot": np.where(rng.random(3000) < 0.4, 0.95, rng.random(3000)),
        "few": rng.integers(0, 5, 3000).astype(float),
        "steep": np.exp(rng.random(3000) * 40),
    }[shape]
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
    row = exact_quantile(frame, "v", share, "q", last_step_values=limit).first()
    assert row["n"] == 3000
    assert row["q"] == pytest.approx(np.quantile(values, share), rel=1e-12)


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_quantile_per_group(spark, limit):
    rng = np.random.default_rng(9)
    groups = {"hot": rng.random(3000), "small": rng.random(3), "same": np.ones(500), None: rng.integers(0, 300, 900).astype(float)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None), ("empty", None)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(4)
    found = {r["g"]: (r["q"], r["n"]) for r in exact_quantile(frame, "v", 0.95, "q", ["g"], limit).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g] == (pytest.approx(np.quantile(values, 0.95), rel=1e-12), len(values))


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5, "q").first()[:] == (None, 0)


def test_checks_do_not_depend_on_the_layout(spark):
    from casebook import queries as Q

    folder = "/root/testdata/sf0.001"
    staged, target = written(Q._work(spark, folder), "staged"), Q._target(spark, folder)

    def found(**layout):
        checked = keys.check_duplicates(staged, Q.ORDERS, staged, **layout)
        checked = keys.check_delete_targets(checked, target, Q.ORDERS, staged, **layout)
        rows = checked.select("o_orderkey", "o_custkey", "process_div", "errors").collect()
        gone = keys.delete_target_missing(staged, target, Q.ORDERS, **layout).select("o_orderkey").collect()
        return sorted(map(repr, rows)), sorted(map(repr, gone))

    small = found()
    assert small == found(**LARGE) == found(rows_per_group=1, broadcast_bytes=0)
    assert any("Error001" in r for r in small[0]) and any("Error004" in r for r in small[0])
