import os
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidegate.model import CONTROL_SCHEMA, ControlColumn, LoadSpec, RunContext, TargetType
from tidegate.operators import control, keys, log, merge
from tidegate.operators.work import to_work
from tidegate.plans.load import LoadOptions, load_table, run_tables
from tidegate.session import scratch_scope, written
from tidegate.sinks import replace as replace_module
from tidegate.sinks.replace import create_versioned, finish_switch, replace_table, swap_partitions
from tidegate.sinks.tables import read_log
from tidegate.streaming.file_drop import file_drop_stream, load_batch_as, load_drops

NOW = datetime(2024, 2, 1, 9, 0, 0)
CTX = RunContext(NOW, "c1", 24)
TARGET = "id bigint, name string, amount decimal(9,2), create_id string, create_dtt timestamp_ntz, last_upd_id string, last_upd_dtt timestamp_ntz"


def control_rows(table, key=True, **limits):
    def row(column, search_key, validation, seq, **more):
        given = {"max_length": None, "min_length": None, "max_value": None, "min_value": None, **more}
        return ("src", table, "wrk", f"w_{table}", "core", f"core_{table}", column, search_key, validation, *given.values(), seq)

    return [
        row("AMOUNT", False, "MinValue", 3, min_value=Decimal(0)),
        row("ID", key, "", 1),
        row("NAME", False, "Required,MaxLength", 2, **limits),
    ]


@pytest.fixture
def world(spark, folder):
    """Three tables and their targets."""
    spark.sql(f"create database if not exists core location '{folder}/core'")
    fresh, stale = NOW - timedelta(hours=1), NOW - timedelta(hours=30)
    sources = {
        "good": [(1, "one", 1.5, fresh), (2, "two", 2.5, fresh), (3, "", 1.0, fresh), (4, "four", -1.0, fresh), (9, "old", 9.0, stale), (5, "five", 1e7, NOW)],
        "empty": [(1, "x", 1.0, stale), (2, "x", 1.0, None)],
        "nokey": [(1, "x", 1.0, fresh)],
        "broken": [],
    }
    frames = {n: spark.createDataFrame(r, "id long, Name string, amount double, update_date_time timestamp_ntz") for n, r in sources.items()}
    old = datetime(2020, 1, 1)
    base = spark.createDataFrame([(2, "deux", Decimal("2.00"), "old", old, "old", old), (7, "sept", Decimal("7.00"), "old", old, "old", old)], TARGET)
    for name in frames:
        spark.sql(f"drop table if exists core.core_{name}")
        create_versioned(base, f"core.core_{name}", f"{folder}/target", f"{name}-0")

    def source_of(name):
        if name == "broken":
            return frames["good"].withColumn("id", F.raise_error(F.lit("lost connection")).cast("bigint"))
        return frames[name]

    return source_of, lambda name: f"core.core_{name}", folder


def load(spark, world, controls, ctx=CTX, **options):
    source_of, target_of, folder = world
    frame = spark.createDataFrame(controls, CONTROL_SCHEMA)
    return run_tables(spark, ctx, frame, source_of, target_of, f"{folder}/work", f"{folder}/target", f"{folder}/log", LoadOptions(**options))


def test_run(spark, world):
    controls = control_rows("good", max_length=5) + control_rows("empty", max_length=5) + control_rows("nokey", key=False, max_length=5) + control_rows("broken", max_length=5)
    good, results = load(spark, world, controls)
    folder = world[2]
    assert not good
    by_table = {r.table: r for r in results}
    assert {t: r.status for t, r in by_table.items()} == {"good": "loaded", "empty": "Info010", "nokey": "Fatal010", "broken": "Fatal007"}
    assert (by_table["good"].total_num, by_table["good"].normal_num, by_table["good"].error_num) == (5, 2, 3)

    rows = {r["id"]: r for r in spark.table("core.core_good").collect()}
    assert set(rows) == {1, 2, 7}
    assert (rows[2]["name"], rows[2]["amount"], rows[2]["create_id"], rows[2]["last_upd_dtt"]) == ("two", Decimal("2.50"), "old", NOW)
    assert (rows[1]["create_id"], rows[1]["create_dtt"], rows[7]["name"]) == ("ETL", NOW, "sept")
    assert {r["id"] for r in spark.table("core.core_empty").collect()} == {2, 7}

    lines = read_log(spark, f"{folder}/log", CTX).orderBy("target_file", "seq").collect()
    errors = [(r["message_cd"], r["item"], r["occurred_key"]) for r in lines if r["level"] == "Error"]
    assert sorted(errors, key=repr) == sorted(
        [("Error003", "NAME", "ID=3"), ("Error009", "AMOUNT", "ID=4"), ("Error010", "AMOUNT", "ID=5")], key=repr
    )
    codes = [r["message_cd"] for r in lines if r["target_file"] == "good" and r["level"] == "Info"]
    assert codes == ["Info003", "Info004", "Info005", "Info006"]
    total = next(r for r in lines if r["message_cd"] == "Info005")
    assert (total["total_num"], total["normal_num"], total["error_num"]) == (5, 2, 3)
    assert total["message"] == "【Info 】 [2024/02/01 09:00:00] 処理合計件数:5件、正常終了:2件、エラー:3件。(good)"
    assert next(r["message"] for r in lines if r["message_cd"] == "Error009").endswith("AMOUNTは-1.0ですが0以上の必要があります。(good)(ID=4)")
    assert {r["customer_id"] for r in lines} == {"c1"} and {r["process_id"] for r in lines} == {"20240201090000"}
    alerts = log.first_alert_per_table(read_log(spark, f"{folder}/log")).collect()
    assert {(r["target_file"], r["level"]) for r in alerts} == {("good", "Error"), ("nokey", "Fatal"), ("broken", "Fatal")}


def test_repeat_is_harmless(spark, world):
    controls = control_rows("good", max_length=5)
    for ctx in (CTX, CTX, RunContext(NOW + timedelta(seconds=1), "c1", 24)):
        good, results = load(spark, world, controls, ctx)
        assert good and results[0].status == "loaded"
        assert {r["id"]: r["name"] for r in spark.table("core.core_good").collect()} == {1: "one", 2: "two", 7: "sept"}
    lines = read_log(spark, f"{world[2]}/log", CTX)
    assert lines.where("message_cd = 'Info005'").count() == 1


def test_old_content_can_be_removed(spark, world):
    folder = world[2]

    def versions():
        return sorted(n for n in os.listdir(f"{folder}/target") if n.startswith(("good-0", "core_good")))

    controls = control_rows("good", max_length=5)
    load(spark, world, controls)
    assert len(versions()) == 2
    load(spark, world, controls, RunContext(NOW + timedelta(seconds=1), "c1", 24), keep_old_content=False)
    assert len(versions()) == 2 and versions()[0].startswith("core_good-20240201090001")
    assert {r["id"] for r in spark.table("core.core_good").collect()} == {1, 2, 7}


def test_side_by_side(spark, world):
    controls = control_rows("good", max_length=5) + control_rows("empty", max_length=5)
    good, results = load(spark, world, controls, parallel_tables=2)
    assert good and {r.status for r in results} == {"loaded", "Info010"}


def test_bad_control_can_end_the_run(spark, world):
    controls = control_rows("good", max_length=None) + control_rows("nokey", max_length=5)
    good, results = load(spark, world, controls, stop_on_bad_control=True)
    assert not good and [r.status for r in results] == ["Fatal012"]


def test_no_tables(spark, world):
    good, results = load(spark, world, [])
    assert good and results == []
    codes = {r["message_cd"] for r in read_log(spark, f"{world[2]}/log").collect()}
    assert codes == {"Info001", "Info007", "Info002"}


def test_divisions_in_the_source(spark, world):
    source_of, target_of, folder = world

    def with_division(*divisions):
        picked = F.element_at(F.array(*map(F.lit, divisions)), (F.col("id") % len(divisions) + 1).cast("int"))
        return lambda name: source_of(name).withColumn("process_div", picked)

    controls = control_rows("good", max_length=5)
    run = (with_division("U", "D"), target_of, folder)
    assert load(spark, run, controls)[1][0].status == "loaded"
    # 1 and 3 are deletes without a target row, 2 is an update, 4 is below the limit.
    assert {r["id"] for r in spark.table("core.core_good").collect()} == {2, 7}
    codes = [r["message_cd"] for r in read_log(spark, f"{folder}/log").collect()]
    assert codes.count("Error001") == 3

    def status(*divisions):
        ctx = RunContext(NOW + timedelta(seconds=len("".join(divisions)) + 1), "c1", 24)
        return load(spark, (with_division(*divisions), target_of, folder), controls, ctx)[1][0].status

    assert status("U", "L") == "Fatal019"
    assert status("Q", "") == "Fatal018"
    assert status("L", "L", "L") == "loaded"
    assert {r["id"] for r in spark.table("core.core_good").collect()} == {1, 2}


def test_customer_check(spark, world):
    source_of, target_of, folder = world
    foreign = (lambda n: source_of(n).withColumn("name", F.lit("c2")), target_of, folder)
    good, results = load(spark, foreign, control_rows("good", max_length=5), customer_column="name")
    assert results[0].status == "Fatal003"


def test_dropped_files_are_loaded(spark, folder):
    spark.sql(f"create database if not exists core location '{folder}/core'")
    spark.sql("drop table if exists core.drops")
    create_versioned(spark.createDataFrame([], TARGET), "core.drops", f"{folder}/target", "drops")
    spec = LoadSpec(
        "drops",
        (
            ControlColumn("id", TargetType("bigint"), True),
            ControlColumn("name", TargetType("text"), rules="Required"),
            ControlColumn("amount", TargetType("numeric", 9, 2)),
        ),
    )
    os.makedirs(f"{folder}/upload")
    schema = spark.createDataFrame([], "id string, name string, amount string, process_div string").schema
    handle = load_batch_as(spec, "core.drops", CTX, f"{folder}/work", f"{folder}/loaded", f"{folder}/log", LoadOptions())

    def drop(name, text):
        with open(f"{folder}/upload/{name}", "w") as out:
            out.write("id,name,amount,process_div\n" + text)
        stream = file_drop_stream(spark, f"{folder}/upload", schema, header="true")
        query = load_drops(stream, handle, f"{folder}/checkpoint")
        query.awaitTermination(120)
        assert query.exception() is None
        spark.catalog.refreshTable("core.drops")
        return {r["id"]: (r["name"], r["amount"]) for r in spark.table("core.drops").collect()}

    assert drop("a.csv", "1,one,1.5,U\n2,two,x,U\n3,,3,U\n4,four,,U\n") == {1: ("one", Decimal("1.50")), 4: ("four", None)}
    assert drop("b.csv", "1,uno,2,U\n4,,,D\n9,,,D\n") == {1: ("uno", Decimal("2.00")), 4: ("four", None)}
    codes = sorted(r["message_cd"] for r in read_log(spark, f"{folder}/log").where("level = 'Error'").collect())
    assert codes == ["Error001", "Error003", "Error003", "Error003", "Error010"]


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_each_file_is_a_load(spark, folder, files_per_batch):
    """Keys repeated across files are updates in turn; a file that stops goes to error/ and its neighbours load."""
    name = f"files{files_per_batch}"
    spark.sql(f"create database if not exists core location '{folder}/core'")
    spark.sql(f"drop table if exists core.{name}")
    create_versioned(spark.createDataFrame([], TARGET), f"core.{name}", f"{folder}/target", name)
    spec = LoadSpec(name, (ControlColumn("id", TargetType("bigint"), True), ControlColumn("name", TargetType("text"))))
    schema = spark.createDataFrame([], "id string, name string, process_div string").schema
    os.makedirs(f"{folder}/upload")
    texts = ["1,one,U\n2,two,U\n", "3,bad,L\n4,bad,U\n", "1,uno,U\nabc,x,U\n0,nil,U\n", "2,,D\n"]
    for n, text in enumerate(texts):
        path = f"{folder}/upload/part {n}.csv"
        with open(path, "w") as out:
            out.write("id,name,process_div\n" + text)
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    handle = load_batch_as(
        spec, f"core.{name}", CTX, f"{folder}/work", f"{folder}/loaded", f"{folder}/log", LoadOptions(),
        f"{folder}/error",
    )
    stream = file_drop_stream(spark, f"{folder}/upload", schema, header="true", files_per_batch=files_per_batch)
    query = load_drops(stream, handle, f"{folder}/checkpoint")
    query.awaitTermination(200)
    assert query.exception() is None
    spark.catalog.refreshTable(f"core.{name}")
    assert {r["id"]: r["name"] for r in spark.table(f"core.{name}").collect()} == {0: "nil", 1: "uno"}
    assert os.listdir(f"{folder}/error") == ["Fatal019"] and os.listdir(f"{folder}/error/Fatal019") == ["part 1.csv"]
    runs = {n for n in os.listdir(f"{folder}/log") if n.startswith("run=")}
    assert len(runs) == 4 and all(r.startswith(f"run={CTX.process_id}-") for r in runs)


def test_ill_typed_keys_are_no_duplicates(spark):
    spec = LoadSpec("k", (ControlColumn("id", TargetType("bigint"), True),))
    rows = spark.createDataFrame([(t, "U") for t in ("0", "abc", "1", "1.5", "7", "07")], "id string, process_div string")
    staged = rows.withColumn("error_flg", F.lit(False))

    def doubled(**options):
        checked = keys.check_duplicates(staged, spec, **options)
        return sorted(r["id"] for r in checked.where("size(errors) > 0").collect())

    assert doubled() == ["07", "7"]
    assert doubled(typed=False) == ["0", "07", "1", "1.5", "7", "abc"]


def test_scopes_keep_each_others_frames(spark):
    with scratch_scope(spark):
        outer = written(spark.range(3), "outer")
        with scratch_scope(spark):
            inner = written(spark.range(5), "inner")
            assert inner.count() == 5
        assert outer.count() == 3


def test_broken_switch_is_finished(spark, folder, monkeypatch):
    spark.sql(f"create database if not exists core location '{folder}/core'")
    spark.sql("drop table if exists core.broken")

    def rows(text, days):
        return spark.createDataFrame([(d, text, f"d{d}") for d in days], "id long, v string, p string")

    create_versioned(rows("old", range(4)), "core.broken", f"{folder}/t", "v", ["p"])
    old = spark.table("core.broken").select("p").distinct().collect()
    steps = []

    def breaking(spark_, table, statements):
        steps.extend(statements)
        for statement in statements[:3]:
            spark_.sql(statement)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(replace_module, "_take", breaking)
        with pytest.raises(RuntimeError):
            swap_partitions(rows("new", range(1, 6)), "core.broken", old, f"{folder}/t", "w")
    spark.catalog.refreshTable("core.broken")
    assert {r["v"] for r in spark.table("core.broken").collect()} == {"old", "new"}
    assert finish_switch(spark, "core.broken", f"{folder}/t")
    assert sorted(tuple(r) for r in spark.table("core.broken").collect()) == [(d, "new", f"d{d}") for d in range(1, 6)]
    assert not finish_switch(spark, "core.broken", f"{folder}/t")


def test_only_touched_partitions_are_written(spark, folder):
    """A date-partitioned target: updates, moves between partitions, deletes and new rows."""
    days = {n: date(2024, 1, n) for n in range(1, 8)}
    spec = LoadSpec(
        "parted",
        (ControlColumn("id", TargetType("bigint"), True), ControlColumn("v", TargetType("text")), ControlColumn("p", TargetType("date"))),
    )
    schema = "id bigint, v string, create_id string, create_dtt timestamp_ntz, last_upd_id string, last_upd_dtt timestamp_ntz, p date"
    old = datetime(2020, 1, 1)
    base = [(i, "old", "old", old, "old", old, d) for i, d in ((1, days[1]), (2, days[2]), (3, days[3]), (4, days[4]), (5, None), (6, days[6]))]
    spark.sql(f"create database if not exists core location '{folder}/core'")
    spark.sql("drop table if exists core.parted")
    create_versioned(spark.createDataFrame(base, schema), "core.parted", f"{folder}/target", "parted-0", ["p"])

    def folders():
        rows = spark.table("core.parted").select("p", F.regexp_extract("_metadata.file_path", "(parted-[^/]+)/", 1)).distinct()
        return {r[0]: r[1] for r in rows.collect()}

    before = folders()
    work = [(2, "new", days[2], "U"), (3, "moved", days[7], "U"), (4, "x", days[4], "D"), (5, "null", None, "U"), (8, "fresh", days[6], "U")]
    source = spark.createDataFrame(
        [(*w, NOW) for w in work], "id long, v string, p date, process_div string, update_date_time timestamp_ntz"
    )
    result = load_table(CTX, spec, source, "core.parted", f"{folder}/work", f"{folder}/target", f"{folder}/log")
    assert (result.status, result.normal_num) == ("loaded", 5)
    found = {(r["id"], r["v"], r["p"]) for r in spark.table("core.parted").collect()}
    assert found == {
        (1, "old", days[1]), (2, "new", days[2]), (3, "moved", days[7]), (5, "null", None), (6, "old", days[6]), (8, "fresh", days[6]),
    }
    after = folders()
    assert {p for p in after if after[p] == before.get(p)} == {days[1]}
    assert set(after) == {days[1], days[2], days[6], days[7], None}
    listed = [r[0] for r in spark.sql("show partitions core.parted").collect()]
    assert sorted(listed) == ["p=2024-01-01", "p=2024-01-02", "p=2024-01-06", "p=2024-01-07", "p=__HIVE_DEFAULT_PARTITION__"]


def test_partition_filter_and_emptied_partition(spark, folder):
    spark.sql(f"create database if not exists core location '{folder}/core'")
    spark.sql("drop table if exists core.daily")
    old = datetime(2020, 1, 1)
    schema = "id bigint, create_id string, create_dtt timestamp_ntz, last_upd_id string, last_upd_dtt timestamp_ntz, p date"
    base = [(i, "old", old, "old", old, date(2024, 1, 1 + i % 3)) for i in range(9)]
    create_versioned(spark.createDataFrame(base, schema), "core.daily", f"{folder}/target", "daily", ["p"])
    spec = LoadSpec("daily", (ControlColumn("id", TargetType("bigint"), True), ControlColumn("p", TargetType("date"))))
    deletes = [(i, date(2024, 1, 1), "D", NOW) for i in (0, 3, 6)]
    source = spark.createDataFrame(deletes, "id long, p date, process_div string, update_date_time timestamp_ntz")

    target = spark.table("core.daily")
    staged = written(to_work(source, spec, CTX), "staged")
    content = merge.merge_partitions(target, staged, spec, CTX, "p", [date(2024, 1, 1)])
    assert re.search(r"PartitionFilters: \[[^\]]*p#", content._jdf.queryExecution().executedPlan().toString())

    options = LoadOptions(keep_old_content=False)
    result = load_table(CTX, spec, source, "core.daily", f"{folder}/work", f"{folder}/target", f"{folder}/log", options)
    assert (result.status, result.normal_num) == ("loaded", 3)
    assert sorted(r["id"] for r in spark.table("core.daily").collect()) == [1, 2, 4, 5, 7, 8]
    assert [r[0] for r in spark.sql("show partitions core.daily").collect()] == ["p=2024-01-02", "p=2024-01-03"]
    assert len([d for d, _, _ in os.walk(f"{folder}/target") if d.endswith("p=2024-01-01")]) == 0


def test_partition_names_are_quoted(spark, folder):
    spark.sql(f"create database if not exists core location '{folder}/core'")
    spark.sql("drop table if exists core.quoted")
    names = ["a b/c", "it's", "x+y%2B", "back\\slash", "日本", None]
    rows = spark.createDataFrame(list(enumerate(names)), "id int, q string")
    create_versioned(rows, "core.quoted", f"{folder}/target", "quoted", ["q"])
    assert {(r["id"], r["q"]) for r in spark.table("core.quoted").collect()} == set(enumerate(names))


def test_replace_by_renaming(spark, folder):
    spark.sql(f"create database if not exists swap location '{folder}/swap'")
    spark.range(3).write.saveAsTable("swap.live")
    replace_table(spark.range(10, 12), "swap.live")
    assert sorted(r["id"] for r in spark.table("swap.live").collect()) == [10, 11]
    assert [t.name for t in spark.catalog.listTables("swap")] == ["live"]


def test_control_specs(spark):
    controls = spark.createDataFrame(control_rows("good", max_length=5), CONTROL_SCHEMA)
    types = {"good": control.target_column_types(spark.createDataFrame([], TARGET))}
    spec = next(control.load_specs(controls, types))
    assert (spec.names, spec.keys) == (["id", "name", "amount"], ["id"])
    assert [(c.type.name, c.type.precision, c.type.scale) for c in spec.columns] == [
        ("bigint", None, None), ("character varying", None, None), ("numeric", 9, 2),
    ]
    assert control.control_errors(controls).isEmpty()
