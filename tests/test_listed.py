"""Targets that are a list of files."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.test_merge import CTX, SPEC, as_set, target_of, work_of
from tidegate.model import ControlColumn, LoadSpec, TargetType
from tidegate.operators import merge
from tidegate.plans.load import LoadOptions, load_table
from tidegate.sinks import listed
from tidegate.sinks.tables import read_work

ONE_KEY = LoadSpec("t", (ControlColumn("k", TargetType("bigint"), True), ControlColumn("v", TargetType("character varying"))))
STAMPS = "create_id string, create_dtt timestamp_ntz, last_upd_id string, last_upd_dtt timestamp_ntz"


def stamped(rows):
    old = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return rows.select("*", F.lit("old").alias("create_id"), old.alias("create_dtt"), F.lit("old").alias("last_upd_id"), old.alias("last_upd_dtt"))


def big_target(spark, many=100_000):
    return stamped(spark.range(many).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")))


def changes(spark, rows):
    frame = spark.createDataFrame(rows, "k string, v string, process_div string")
    return frame.withColumn("error_flg", F.lit(False))


@pytest.fixture
def big(spark, folder):
    name = f"listed_{random.randrange(10**9)}"
    listed.create_listed(big_target(spark), name, f"{folder}/big", "v0", ["k"], files=50)
    return name, f"{folder}/big"


def scanned(df):
    """Files and rows that the scans of a plan which ran gave."""
    plan, found = df._jdf.queryExecution().executedPlan(), [0, 0]

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            for i, name in enumerate(("numFiles", "numOutputRows")):
                found[i] += node.metrics().apply(name).value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found


def test_small_load_writes_little(spark, big):
    name, root = big
    before = listed.listing(spark, name)
    whole, size = spark.table(name), sum(f.byte_cnt for f in before.live)
    rows = [(str(k), "new", "U") for k in range(50_000, 50_080)] + [("50090", None, "D"), ("200000", "added", "U")]
    work = changes(spark, rows)
    want = as_set(merge.merge_work(whole, work, ONE_KEY, CTX))
    listed.merge_listed(name, work, ONE_KEY, CTX, root, "v1")
    after = listed.listing(spark, name)
    new = [f for f in after.live if f not in before.files]
    assert sum(f.byte_cnt for f in new) < 0.05 * size
    assert len(before.live) == 50 and len([f for f in after.files if not f.live]) == 1
    assert as_set(spark.table(name)) == want
    # A reader's own filter still goes to the files, and those left out are not opened.
    read = spark.table(name).where("k = 50001").select("v")
    assert [r.v for r in read.collect()] == ["new"] and scanned(read)[0] == len(after.live)


def test_ranges_and_filters_leave_files_out(spark, big):
    name, _ = big
    files = listed.listing(spark, name).live
    wanted = spark.createDataFrame([(k,) for k in (10, 11, 70_000, 10**9, None)], "k long")
    ranges = listed.key_ranges(wanted, "k")
    near = listed.meeting(files, ranges)
    assert len(near) == 2 and {f.low <= 10 or f.low <= 70_000 <= f.high for f in near} == {True}
    assert listed.holding(spark, spark.table(name).schema, files, wanted.where("k IS NOT NULL"), ["k"]) == near
    # Keys that the file's range covers but the file does not hold: its Bloom filter tells.
    even = stamped(spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("v")))
    folder, found = listed._write(even, f"{big[1]}/even", "e", ["k"], 1)
    odd = listed.read_files(spark, even.schema, found).where(F.col("k").isin(list(range(1, 100, 2))))
    assert odd.collect() == [] and scanned(odd)[1] == 0
    full = listed.read_files(spark, even.schema, found).where("k % 2 = 1")
    assert full.collect() == [] and scanned(full)[1] == 10_000


def test_ranges_miss_no_value(spark):
    rng = random.Random(4)
    values = [Decimal(rng.randrange(-(10**6), 10**6)) / 100 for _ in range(3_000)]
    ranges = listed.key_ranges(spark.createDataFrame([(v,) for v in values] + [(None,)], "k decimal(12,2)"), "k")
    assert len(ranges) > 50 and ranges == sorted(ranges)
    assert all(any(a <= float(v) <= b for a, b in ranges) for v in values)
    files = [listed.File("f", str(i), True, 1, 1, Decimal(i), Decimal(i + 1)) for i in range(-12_000, 12_000, 7)]
    near = set(listed.meeting(files, ranges))
    assert near == {f for f in files if any(a <= float(f.high) and float(f.low) <= b for a, b in ranges)}
    assert listed.meeting([listed.File("f", "n", True, 1, 1, None, None)], ranges) == []
    other = listed.File("f", "t", True, 1, 1, "text", "text")
    assert listed.meeting([other], ranges) == [other]
    assert listed.key_ranges(spark.createDataFrame([], "k long"), "k") == []


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_turn_equal_whole_merges(spark, folder, seed):
    """Random loads with two-part keys, repeated and null target keys, and folders that are folded."""
    rng, name = random.Random(seed), f"turn_{seed}"
    days = [None, *(datetime(2024, 1, d).date() for d in range(1, 5))]
    rows = [(rng.choice([None, *range(40)]), rng.choice(days), rng.randrange(9)) for _ in range(300)]
    plain = target_of(spark, rows)
    listed.create_listed(plain, name, f"{folder}/turn", "v", ["a", "b"], files=12)
    content = as_set(plain)
    assert as_set(spark.table(name)) == content
    for step in range(6):
        keys = {(rng.randrange(50), rng.randrange(1, 5)): rng.choice("UUD") for _ in range(6)}
        work = work_of(spark, [(str(a), f"2024-01-0{d}", str(step), div) for (a, d), div in keys.items()] + [("", "2024-01-01", "7", "U")])
        want = as_set(merge.merge_work(spark.table(name), work, SPEC, CTX))
        listed.merge_listed(name, work, SPEC, CTX, f"{folder}/turn", f"s{step}", keep_old=step % 2 == 0, max_folders=3)
        assert as_set(spark.table(name)) == want
        assert len({f.folder for f in listed.listing(spark, name).live}) <= 3


def test_a_load_that_fails_changes_nothing(spark, big):
    name, root = big
    before = as_set(spark.table(name).where("k < 100"))
    bad = changes(spark, [("5", "new", "U")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        listed.merge_listed(name, bad, ONE_KEY, CTX, root, "v1")
    assert as_set(spark.table(name).where("k < 100")) == before


def test_replacement_and_empty_targets(spark, folder):
    root, name = f"{folder}/r", "replaced_list"
    listed.create_listed(big_target(spark, 10), name, root, "v0", ["k"], files=2)
    first = {f.folder for f in listed.listing(spark, name).live}
    gone = changes(spark, [(str(k), None, "D") for k in range(10)])
    listed.merge_listed(name, gone, ONE_KEY, CTX, root, "v1", keep_old=False)
    assert spark.table(name).collect() == [] and listed.listing(spark, name).files == ()
    path = spark._jvm.org.apache.hadoop.fs.Path(next(iter(first)))
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    listed.merge_listed(name, changes(spark, [("3", "c", "U")]), ONE_KEY, CTX, root, "v2")
    assert [(r.k, r.v) for r in spark.table(name).collect()] == [(3, "c")]
    listed.replace_listed(name, changes(spark, [("4", "d", "L"), ("6", "e", "L")]), ONE_KEY, CTX, root, "v3")
    assert sorted((r.k, r.v) for r in spark.table(name).collect()) == [(4, "d"), (6, "e")]


def test_whole_load_into_a_list(spark, folder):
    """The nightly load's own path: stage, check deletes against the files they may be in, merge, log."""
    name = "core_listed"
    listed.create_listed(big_target(spark, 1_000), name, f"{folder}/t", "v0", ["k"], files=10)
    source = spark.createDataFrame(
        [("5", "five", "U"), ("7", None, "D"), ("5000", None, "D"), ("2000", "more", "U"), ("bad", "x", "U")],
        "k string, v string, process_div string",
    )
    result = load_table(
        CTX, ONE_KEY, source, name, f"{folder}/work", f"{folder}/t", f"{folder}/log", LoadOptions(whole_source=True)
    )
    assert (result.status, result.total_num, result.normal_num, result.error_num) == ("loaded", 5, 3, 2)
    rows = {r.k: r.v for r in spark.table(name).collect()}
    assert len(rows) == 1_000 and rows[5] == "five" and rows[2000] == "more" and 7 not in rows
    checked = read_work(spark, f"{folder}/work/t/checked").where("error_flg").select("k").collect()
    assert sorted(r.k for r in checked) == ["5000", "bad"]
    staged = read_work(spark, f"{folder}/work/t/staged")
    assert len(listed.for_deletes(spark, name, staged, ONE_KEY).inputFiles()) <= 2


def test_rows_of_a_file_are_bounded(spark, folder, monkeypatch):
    # A file is sorted in one task: however few bytes the rows compress to, no task gets all of a large load.
    monkeypatch.setattr(listed, "FILE_ROWS", 2_000)
    name, root = f"listed_{random.randrange(10**9)}", f"{folder}/rows"
    listed.create_listed(big_target(spark, 20_000), name, root, "v0", ["k"], files=1)
    made = listed.listing(spark, name).live
    assert len(made) >= 10 and max(f.row_cnt for f in made) <= 4_000
    work = changes(spark, [(str(k), "new", "U") for k in range(0, 20_000, 2)] + [(str(k), "added", "U") for k in range(20_000, 30_000)])
    want = as_set(merge.merge_work(spark.table(name), work, ONE_KEY, CTX))
    listed.merge_listed(name, work, ONE_KEY, CTX, root, "v1")
    after = listed.listing(spark, name).live
    assert max(f.row_cnt for f in after) <= 4_000 and sum(f.row_cnt for f in after) == 30_000
    assert as_set(spark.table(name)) == want
