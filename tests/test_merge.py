import random
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook import queries as Q
from tidegate.model import ControlColumn, LoadSpec, RunContext, TargetType
from tidegate.operators import merge, rules
from tidegate.plans.load import LoadOptions, check_work
from tidegate.session import written

FOLDER = "/root/testdata/sf0.001"
CTX = RunContext(datetime(2024, 2, 1, 9, 0, 0), "c1", 24)
SPEC = LoadSpec(
    "t",
    (
        ControlColumn("a", TargetType("bigint"), True),
        ControlColumn("b", TargetType("date"), True),
        ControlColumn("v", TargetType("numeric", 9, 2)),
    ),
)
TARGET = "a bigint, b date, v decimal(9,2), extra string, create_id string, create_dtt timestamp_ntz, last_upd_id string, last_upd_dtt timestamp_ntz"


def as_set(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def target_of(spark, rows):
    old = datetime(2020, 1, 1)
    return spark.createDataFrame([(a, b, Decimal(v), "x", "old", old, "old", old) for a, b, v in rows], TARGET)


def work_of(spark, rows):
    schema = "a string, b string, v string, process_div string"
    frame = spark.createDataFrame(rows, schema).withColumn("error_flg", F.lit(False))
    return written(frame, "work")


@pytest.fixture(scope="module")
def orders(spark):
    checked = written(Q._checked(spark, FOLDER), "checked")
    return Q._target(spark, FOLDER), checked


def test_one_plan_equals_the_three_in_turn(orders):
    target, checked = orders
    once = merge.merge_work(target, checked, Q.ORDERS, CTX)
    turn = merge.update_from(target, checked, Q.ORDERS, CTX)
    turn = merge.insert_missing(turn, checked, Q.ORDERS, CTX)
    turn = merge.delete_using(turn, checked, Q.ORDERS, CTX)
    assert as_set(once) == as_set(turn)


def test_merging_twice_changes_nothing(orders):
    target, checked = orders
    once = written(merge.merge_work(target, checked, Q.ORDERS, CTX), "once")
    assert as_set(merge.merge_work(once, checked, Q.ORDERS, CTX)) == as_set(once)


def test_flagged_rows_never_arrive(orders):
    target, checked = orders
    merged = merge.merge_work(target, checked, Q.ORDERS, CTX)
    stamped = merged.where(F.col("last_upd_dtt") == F.lit(CTX.run_ts)).select(F.col("o_orderkey").cast("string"))
    assert stamped.join(checked.where("error_flg"), "o_orderkey", "left_semi").isEmpty()
    assert merged.groupBy("o_orderkey").count().where("count > 1").isEmpty()


def test_rows_add_up(orders):
    _, checked = orders
    applied = checked.where("process_div in ('U', 'D', 'L') and not error_flg").count()
    flagged = checked.where("error_flg").count()
    blank = checked.where("process_div is null or process_div = ''").count()
    assert checked.count() == applied + flagged + blank


def test_composite_key_duplicate_and_null_target_keys(spark):
    day = date(2024, 1, 1)
    target = target_of(spark, [(1, day, 1), (1, day, 2), (None, day, 3), (2, None, 4), (3, day, 5), (5, day, 6)])
    work = work_of(
        spark,
        [("1", "2024/1/1", "9.999", "U"), ("3", "20240101", "", "D"), ("4", "2024-01-01", "x", "U"), ("", "2024-01-01", "7", "U"), ("5", "2024-01-01", "8", "Z")],
    )
    merged = merge.merge_work(target, work, SPEC, CTX).orderBy("a", "v").collect()
    found = sorted(((r["a"], r["b"], r["v"], r["extra"], r["create_id"], r["last_upd_id"]) for r in merged), key=repr)
    assert found == sorted(
        [
            (1, day, Decimal("10.00"), "x", "old", "ETL"),
            (1, day, Decimal("10.00"), "x", "old", "ETL"),
            (None, day, Decimal("3.00"), "x", "old", "old"),
            (2, None, Decimal("4.00"), "x", "old", "old"),
            (5, day, Decimal("6.00"), "x", "old", "old"),
            (4, day, Decimal("0.00"), None, "ETL", "ETL"),
            (None, day, Decimal("7.00"), None, "ETL", "ETL"),
        ],
        key=repr,
    )


def test_spellings_of_one_key_are_duplicates(spark):
    target = target_of(spark, [])
    rows = [("1", "2024-01-01", "1", "U"), ("01", "2024/01/01", "2", "U"), ("2", "2024-01-01", "3", "U")]
    checked = check_work(work_of(spark, rows), target, SPEC)
    assert sorted(r["a"] for r in checked.where("error_flg").collect()) == ["01", "1"]


def test_random_merges(spark):
    rng = random.Random(11)
    for _ in range(3):
        keys = rng.sample(range(60), 30)
        target = target_of(spark, [(k, date(2024, 1, 1), k) for k in keys])
        work = [(str(k), "2024-01-01", str(k + 100), rng.choice("UD")) for k in rng.sample(range(60), 25)]
        expected = {k: k for k in keys}
        for k, _, v, division in work:
            if division == "U":
                expected[int(k)] = int(v)
            else:
                expected.pop(int(k), None)
        merged = merge.merge_work(target, work_of(spark, work), SPEC, CTX)
        assert {r["a"]: int(r["v"]) for r in merged.collect()} == expected


def test_rules_can_be_limited(spark):
    spec = replace(SPEC, columns=(*SPEC.columns[:2], replace(SPEC.columns[2], rules="MinValue", min_value=0)))
    work = work_of(spark, [("x", "2024-01-01", "-1", "U"), ("y", "bad", "1", "U")])
    only = LoadOptions(row_rules=("MinValue",), check_duplicates=False, require_keys=False)
    checked = check_work(work, target_of(spark, []), spec, only)
    assert [(r["a"], [e["code"] for e in r[rules.ERRORS]]) for r in checked.orderBy("a").collect()] == [
        ("x", ["Error009"]), ("y", []),
    ]


def test_keys_are_required_whatever_else_is_checked(spark):
    work = work_of(spark, [("", "2024-01-01", "1", "U"), ("1", "", "1", "U"), ("2", "2024-01-01", "1", "U")])
    only = LoadOptions(row_rules=(), check_duplicates=False)
    checked = check_work(work, target_of(spark, []), SPEC, only)
    assert sorted((r["a"], r["b"]) for r in checked.where("error_flg").collect()) == [("", "2024-01-01"), ("1", "")]


def test_division_rules_when_replacing(spark):
    work = work_of(spark, [("1", "2024-01-01", "1", "L"), ("2", "2024-01-01", "1", "U"), ("3", "2024-01-01", "1", "")])
    checked = check_work(work, target_of(spark, []), SPEC, has_updates=False, has_replace=True)
    assert [(r["a"], r["error_flg"]) for r in checked.orderBy("a").collect()] == [("1", False), ("2", True), ("3", False)]
    content = merge.replacement_rows(target_of(spark, []), checked, SPEC, CTX).collect()
    assert [(r["a"], r["extra"], r["create_id"]) for r in content] == [(1, None, "ETL")]
