"""One query per operator, over whole test tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebook.fixtures import TABLES, fixture, table
from tidegate.functions import conditions as C
from tidegate.functions import convert as V
from tidegate.functions.text import action_text, clip_message, fill, format_message, key_text, level_of_code, wall_stamp
from tidegate.model import ControlColumn, LoadSpec, RunContext, TargetType
from tidegate.operators import control, inventory, keys, log, merge, rules, work
from tidegate.plans import slo, warehouse
from tidegate.plans.load import LoadOptions, check_work, load_rows, load_table
from tidegate.session import scratch_dir, written
from tidegate.sinks.inventory import write_inventory_csv
from tidegate.sinks.listed import create_listed
from tidegate.sinks.replace import create_versioned, replace_table
from tidegate.sinks.tables import (
    append_log,
    archive_or_quarantine,
    bulk_append,
    pack_log,
    quarantine_split,
    read_log,
    read_work,
    truncate_and_load,
    unload_partitioned,
)
from tidegate.sources.catalog import discover_schemas, merge_crawl
from tidegate.sources.extract import bounded_extract, external_scan, incremental_extract, sample_extract
from tidegate.sources.files import file_drop_scan, land_then_load
from tidegate.streaming.file_drop import file_drop_stream, load_batch_as, load_drops

CTX = RunContext(datetime(2024, 2, 1, 9, 0, 0), customer_id="c1", term_hours=24)
EXTRACT_CTX = RunContext(datetime(2000, 1, 1, 12, 0, 0), customer_id="c1", term_hours=24 * 400)

ORDERS = LoadSpec(
    "orders",
    (
        ControlColumn("o_orderkey", TargetType("bigint"), True, "Required"),
        ControlColumn("o_custkey", TargetType("bigint")),
        ControlColumn("o_totalprice", TargetType("numeric", 18, 2), False, "MaxValue,MinValue", max_value=400000, min_value=0),
        ControlColumn("o_orderdate", TargetType("date"), False, "Required"),
        ControlColumn("o_orderstatus", TargetType("character varying"), False, "MaxLength,MinLength", 1, 1),
        ControlColumn("note", TargetType("character varying"), False, "MaxLength", 15),
    ),
    target_table="core_orders",
)
EVENTS = LoadSpec(
    "events",
    (
        ControlColumn("event_id", TargetType("bigint"), True, "Required"),
        ControlColumn("at_text", TargetType("timestamp without time zone")),
        ControlColumn("time_text", TargetType("time without time zone")),
        ControlColumn("value_text", TargetType("double precision")),
        ControlColumn("code_text", TargetType("character")),
    ),
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def doubles(rows: DataFrame, *names: str) -> DataFrame:
    """Decimals as doubles, the form in which results are compared."""
    return rows.withColumns({n: F.col(n).cast("double") for n in names})


def _work(spark: SparkSession, folder: str) -> DataFrame:
    return work.to_work(fixture(spark, folder, "work_orders"), ORDERS, CTX)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return work.to_work(fixture(spark, folder, "work_events"), EVENTS, CTX)


def _target(spark: SparkSession, folder: str) -> DataFrame:
    return fixture(spark, folder, "target_orders")


# Checked rows by folder, prepared once where queries are timed: what they time is then the operator they name.
PREPARED: dict[str, DataFrame] = {}


def prepare(spark: SparkSession, folder: str) -> None:
    PREPARED[folder] = written(_checked(spark, folder), "checked")


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    if folder in PREPARED:
        return PREPARED[folder]
    staged = written(_work(spark, folder), "staged")
    return check_work(staged, _target(spark, folder), ORDERS, LoadOptions(), has_deletes=True)


def _settled(spark: SparkSession, folder: str) -> DataFrame:
    """Checked rows as a written table, for results that read them more than once."""
    return PREPARED[folder] if folder in PREPARED else written(_checked(spark, folder), "checked")


# Extracts.


@query
def incremental_extract_orders(spark, folder):
    return incremental_extract(fixture(spark, folder, "src_orders"), EXTRACT_CTX)


@query
def bounded_extract_orders(spark, folder):
    return bounded_extract(fixture(spark, folder, "src_orders"), EXTRACT_CTX)


# Control rows.


@query
def target_tables(spark, folder):
    return control.target_tables(fixture(spark, folder, "control_rows"))


@query
def load_controls(spark, folder):
    return doubles(control.load_controls(fixture(spark, folder, "control_rows")), "max_value", "min_value")


@query
def control_check_counts(spark, folder):
    return control.control_check_counts(fixture(spark, folder, "control_rows"))


@query
def control_unknown_rules(spark, folder):
    counts = control.control_check_counts(fixture(spark, folder, "control_rows"))
    return counts.where(F.col("unknown_rules") > 0).select("aurora_table", "unknown_rules")


@query
def control_errors(spark, folder):
    return control.control_errors(fixture(spark, folder, "control_rows"))


# Inventory.


@query
def schema_inventory(spark, folder):
    return inventory.schema_inventory(fixture(spark, folder, "meta_objects"))


@query
def table_inventory(spark, folder):
    return inventory.table_inventory(fixture(spark, folder, "meta_tables"), fixture(spark, folder, "meta_objects"))


@query
def column_inventory(spark, folder):
    return inventory.column_inventory(fixture(spark, folder, "meta_columns"), fixture(spark, folder, "meta_objects"))


@query
def discover_schemas_tables(spark, folder):
    """Column catalogue of all tables, with the number of filled values of each column."""
    found = discover_schemas(spark, {t: f"{folder}/{t}.parquet" for t in TABLES})
    sizes = None
    for name in TABLES:
        rows = table(spark, folder, name)
        filled = F.array(
            *(F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`")).alias("filled")) for c in rows.columns)
        )
        counted = rows.agg(F.explode(filled).alias("f")).select(F.lit(name).alias("dataset"), "f.*")
        sizes = counted if sizes is None else sizes.unionByName(counted)
    return found.join(sizes, ["dataset", "column"]).drop("nullable")


@query
def merged_catalog(spark, folder):
    """The catalogue after a second crawl: a column renamed, one of another type, a dataset come and one gone."""

    def orders():
        rows = table(spark, folder, "orders")
        return rows.withColumnRenamed("o_custkey", "o_customer").withColumn("o_totalprice", F.col("o_totalprice").cast("float"))

    path = {t: f"{folder}/{t}.parquet" for t in ("orders", "customer", "nation", "region")}
    known = discover_schemas(spark, {t: path[t] for t in ("orders", "customer", "nation")})
    found = discover_schemas(spark, {"orders": orders, "customer": path["customer"], "region": path["region"]})
    return merge_crawl(known, found).drop("nullable")


# Work rows.


@query
def normalise_work(spark, folder):
    return _work(spark, folder)


@query
def live_rows(spark, folder):
    return work.live_rows(_work(spark, folder)).select("o_orderkey", "o_custkey", "process_div")


@query
def rows_of_division(spark, folder):
    return work.rows_of_division(_checked(spark, folder), "U", error_free=True).select("o_orderkey", "process_div")


@query
def invalid_division(spark, folder):
    return work.invalid_division(_work(spark, folder)).select("o_orderkey", "process_div")


@query
def division_counts(spark, folder):
    return work.division_counts(_checked(spark, folder), count_error=False)


@query
def work_counts(spark, folder):
    return work.work_counts(_checked(spark, folder))


# Conversions.


def _converted(spark, folder, column, name, make, rows=_work, key="o_orderkey") -> DataFrame:
    return rows(spark, folder).select(key, column, make(F.col(column)).alias(name))


@query
def convert_int(spark, folder):
    return _converted(spark, folder, "o_custkey", "as_bigint", V.to_int)


@query
def convert_smallint(spark, folder):
    return _converted(spark, folder, "o_custkey", "as_smallint", lambda c: V.to_int(c, "smallint"))


@query
def convert_float(spark, folder):
    return _converted(spark, folder, "value_text", "as_double", V.to_float, _events, "event_id")


@query
def convert_decimal(spark, folder):
    return doubles(_converted(spark, folder, "o_totalprice", "as_decimal", lambda c: V.to_decimal(c, 18, 2)), "as_decimal")


@query
def convert_date(spark, folder):
    return _converted(spark, folder, "o_orderdate", "as_date", V.to_date)


@query
def convert_date_of_timestamp(spark, folder):
    return _converted(spark, folder, "at_text", "as_date", V.to_date, _events, "event_id")


@query
def convert_timestamp(spark, folder):
    return _converted(spark, folder, "at_text", "as_ts", V.to_timestamp, _events, "event_id")


@query
def convert_string(spark, folder):
    return _converted(spark, folder, "note", "as_string", V.to_string)


@query
def convert_bool(spark, folder):
    rows = work.to_text_row(fixture(spark, folder, "work_orders"), ["o_orderkey", "is_urgent"])
    return rows.select("o_orderkey", "is_urgent", V.to_bool(F.col("is_urgent")).alias("as_bool"))


@query
def typed_keys(spark, folder):
    """Key values as they are matched against a target, for one column of each type family."""
    kinds = {"o_orderkey": "bigint", "o_totalprice": "numeric", "o_orderdate": "date", "o_orderstatus": "text"}
    rows = _work(spark, folder)
    return rows.select(
        *(V.typed_key(F.col(c), TargetType(k, 18, 2)).alias(f"{c}_key") for c, k in kinds.items()), *kinds
    )


@query
def project_typed(spark, folder):
    return doubles(merge.project_typed(_checked(spark, folder), ORDERS, CTX), "o_totalprice")


# Type and overflow rules.


def _failing(rows: DataFrame, key: str, column: str, condition: Column) -> DataFrame:
    return work.live_rows(rows).where(condition).select(key, column)


def _check(name: str, column: str, make: Callable[[Column], Column], rows=_work, key: str = "o_orderkey") -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _failing(rows(spark, folder), key, column, make(F.col(column)))

    QUERIES[name] = run


_check("check_type_int", "o_custkey", C.bad_int)
_check("check_type_decimal", "o_totalprice", C.bad_decimal)
_check("check_single_byte", "code_text", C.not_single_byte, _events, "event_id")
_check("check_date", "o_orderdate", C.bad_date)
_check("check_timestamp", "at_text", C.bad_timestamp, _events, "event_id")
_check("check_time", "time_text", C.bad_time, _events, "event_id")
_check("check_overflow_int", "o_custkey", C.int_overflow)
_check("check_overflow_smallint", "o_custkey", lambda c: C.int_overflow(c, "smallint"))
_check("check_overflow_decimal", "o_totalprice", lambda c: C.decimal_overflow(c, 8, 2))
_check("check_overflow_float", "value_text", C.float_overflow, _events, "event_id")
_check("check_required", "o_orderstatus", C.missing)
_check("check_max_length", "note", lambda c: C.too_long(c, 15))
_check("check_min_length", "o_orderstatus", lambda c: C.too_short(c, 1))
_check("check_max_value", "o_totalprice", lambda c: C.above(c, 400000))
_check("check_min_value", "o_totalprice", lambda c: C.below(c, 0))


@query
def check_type_bool(spark, folder):
    rows = work.to_text_row(fixture(spark, folder, "work_orders"), ["o_orderkey", "is_urgent"])
    return _failing(rows, "o_orderkey", "is_urgent", C.bad_bool(F.col("is_urgent")))


@query
def check_text_length(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").where(C.too_long(text, 2000)).select("doc_id", F.length(text).alias("n"))


# Checks by key and division.


@query
def duplicate_keys(spark, folder):
    return keys.duplicate_keys(_work(spark, folder), ["o_orderkey"])


@query
def rows_with_duplicate_key(spark, folder):
    return keys.rows_with_duplicate_key(_work(spark, folder), ["o_orderkey"]).select("o_orderkey", "o_custkey", "process_div")


@query
def rows_with_duplicate_key_pair(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("process_div", F.lit("U"))
    found = keys.rows_with_duplicate_key(rows, ["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _division_errors(rows: DataFrame, has_updates: bool, has_replace: bool) -> DataFrame:
    checked = rules.with_errors(rows, rules.division_rules(has_updates, has_replace))
    found = checked.select("o_orderkey", "process_div", F.explode(rules.ERRORS).alias("e"))
    return found.select("o_orderkey", "process_div", "e.code", "e.item", "e.message")


@query
def check_not_ud(spark, folder):
    return _division_errors(_work(spark, folder), True, False)


@query
def check_not_l(spark, folder):
    return _division_errors(fixture(spark, folder, "work_replace"), False, True)


@query
def check_file_division(spark, folder):
    def one(name: str, rows: DataFrame) -> DataFrame:
        return work.file_divisions(work.division_counts(rows)).select(F.lit(name).alias("load"), "*")

    return one("mixed", fixture(spark, folder, "work_replace")).unionByName(one("plain", _work(spark, folder)))


@query
def customer_check(spark, folder):
    foreign = F.col("o_custkey").endswith("7")
    rows = _work(spark, folder).withColumn("customer_id", F.when(foreign, "c2").otherwise("c1"))
    return keys.customer_errors(rows, CTX.customer_id).select("o_orderkey", "customer_id")


@query
def delete_target_missing(spark, folder):
    found = keys.delete_target_missing(_work(spark, folder), _target(spark, folder), ORDERS)
    return found.select("o_orderkey", "o_custkey", "process_div")


@query
def flag_by_row_id(spark, folder):
    rows = table(spark, folder, "events").withColumn("error_flg", F.lit(False))
    ids = table(spark, folder, "events").where(F.col("event_type") == "error").select("event_id")
    return keys.flag_by_row_id(rows, ids, "event_id").select("event_id", "event_type", "error_flg")


# Applying.


@query
def update_from(spark, folder):
    return doubles(merge.update_from(_target(spark, folder), _settled(spark, folder), ORDERS, CTX), "o_totalprice")


@query
def insert_missing(spark, folder):
    return doubles(merge.insert_missing(_target(spark, folder), _settled(spark, folder), ORDERS, CTX), "o_totalprice")


@query
def delete_using(spark, folder):
    return doubles(merge.delete_using(_target(spark, folder), _settled(spark, folder), ORDERS, CTX), "o_totalprice")


@query
def merge_work(spark, folder):
    return doubles(merge.merge_work(_target(spark, folder), _settled(spark, folder), ORDERS, CTX), "o_totalprice")


@query
def merge_partitions(spark, folder):
    """The merged content of the days a load touches, for a target partitioned by day."""
    target, checked = _target(spark, folder), _settled(spark, folder)
    days = merge.touched_values(target, checked, ORDERS, CTX, "o_orderdate").collect()
    return doubles(merge.merge_partitions(target, checked, ORDERS, CTX, "o_orderdate", [r[0] for r in days]), "o_totalprice")


@query
def replacement_rows(spark, folder):
    content = merge.replacement_rows(_target(spark, folder), fixture(spark, folder, "work_replace"), ORDERS, CTX)
    return doubles(content, "o_totalprice")


@query
def load_orders(spark, folder):
    """The whole path of a nightly load: extract, clean, check, convert, merge."""
    source = fixture(spark, folder, "src_orders").withColumnRenamed("o_orderpriority", "note")
    source = source.withColumn("o_orderdate", F.to_date("o_orderdate"))
    return doubles(load_rows(source, _target(spark, folder), ORDERS, EXTRACT_CTX)[1], "o_totalprice")


# Log.


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return log.error_log(_checked(spark, folder), ORDERS, CTX)


@query
def error_log(spark, folder):
    return _log(spark, folder)


@query
def flagged_rows(spark, folder):
    return _checked(spark, folder).select(
        "o_orderkey", "process_div", "error_flg", F.size(rules.ERRORS).alias("error_cnt")
    )


@query
def first_alert_per_table(spark, folder):
    events = rules.with_errors(written(_events(spark, folder), "staged"), rules.row_rules(EVENTS))
    both = log.collect_errors(_log(spark, folder), log.error_log(events, EVENTS, CTX))
    return log.first_alert_per_table(both).select("target_file", "level", "seq", "message_cd")


@query
def error_profile(spark, folder):
    return log.error_profile(_log(spark, folder))


@query
def run_summary(spark, folder):
    return log.run_summary(_checked(spark, folder), ORDERS)


@query
def step_elapsed(spark, folder):
    lines = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return log.step_elapsed(lines, "user_id", "ts", ["event_id"])


@query
def span_totals(spark, folder):
    return log.span_totals(fixture(spark, folder, "run_marks"), "run", "title", "status", "ts", ["event_id"])


@query
def log_texts(spark, folder):
    """The text functions of log lines, on events."""
    rows = table(spark, folder, "events").withColumn(
        "code", F.concat(F.initcap(F.when(F.col("event_type") == "view", "warn").otherwise(F.col("event_type"))), F.lit("001"))
    )
    level = level_of_code(F.col("code"))
    named = rows.withColumn("user_text", F.col("user_id").cast("string")).withColumn("type_text", F.col("event_type"))
    return named.select(
        "event_id",
        level.alias("level"),
        format_message(CTX, level, F.col("props"), F.col("event_type"), F.nullif(F.col("user_text"), F.lit("7"))).alias("message"),
        key_text(["user_text", "type_text"]).alias("key_text"),
        clip_message(F.repeat("props", 1000)).alias("clipped"),
        wall_stamp(F.col("ts")).alias("stamp"),
        action_text(F.col("user_id") % 3 == 0, F.col("user_id") % 3 == 1, F.col("event_id") % 2 == 0).alias("action"),
        fill("{a}は{b}桁です", a=F.col("event_type"), b=F.col("user_text")).alias("filled"),
    )


# Writing and reading back.


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def land_and_load(spark, folder):
    rows = incremental_extract(fixture(spark, folder, "src_orders"), EXTRACT_CTX)
    return land_then_load(rows, _folder(spark, "landing"))


@query
def work_table(spark, folder):
    """Updates loaded into an emptied work table, then the other divisions appended."""
    rows, path = fixture(spark, folder, "work_orders"), _folder(spark, "work")
    truncate_and_load(rows.where("process_div = 'U'"), path)
    bulk_append(rows.where("process_div <> 'U'"), path)
    return read_work(spark, path)


@query
def written_log(spark, folder):
    path = _folder(spark, "log")
    append_log(_log(spark, folder), path, CTX, "orders", "errors")
    return read_log(spark, path, CTX)


@query
def packed_log(spark, folder):
    """A day's log packed, with lines of two runs, one of them written again afterwards."""
    path, lines = _folder(spark, "log"), written(_log(spark, folder), "lines")
    again = replace(CTX, tag="again")
    append_log(lines, path, CTX, "orders", "errors")
    append_log(lines, path, again, "orders", "errors")
    pack_log(spark, path, CTX.run_ts.date())
    append_log(lines.limit(0), path, again, "orders", "errors")
    return read_log(spark, path)


@query
def written_inventory(spark, folder):
    rows, path = table_inventory(spark, folder), _folder(spark, "inventory")
    write_inventory_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def preview_tables(spark, folder):
    return inventory.preview(table_inventory(spark, folder), 20)


@query
def sample_extract_orders(spark, folder):
    return sample_extract(table(spark, folder, "orders"), 1000)


@query
def sample_of_orders(spark, folder):
    """How many rows a sample has, and how many of them are orders."""
    orders = table(spark, folder, "orders")
    rows = sample_extract(orders, 1000)
    # Orders as a semi join: a row that is none would not be counted.
    real = rows.join(orders.select("o_orderkey", "o_custkey").distinct(), ["o_orderkey", "o_custkey"], "left_semi")
    marked = rows.select(F.lit(1).alias("n"), F.lit(0).alias("found"))
    return marked.unionByName(real.select(F.lit(0).alias("n"), F.lit(1).alias("found"))).agg(
        F.sum("n").alias("n"), F.sum("found").alias("found")
    )


@query
def empty_load(spark, folder):
    """The log of a load without changed rows, and the target it leaves as it is."""
    name, base = _target_table(spark, folder, []), _folder(spark, "load")
    stale = F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")
    source = fixture(spark, folder, "work_orders").withColumn("update_date_time", stale)
    load_table(CTX, ORDERS, source, name, f"{base}/work", f"{base}/target", f"{base}/log")
    lines = read_log(spark, f"{base}/log", CTX).select("level", "message_cd")
    rows = spark.table(name).select(F.lit("target").alias("level"), F.lit("rows").alias("message_cd"))
    return lines.unionByName(rows).groupBy("level", "message_cd").agg(F.count(F.lit(1)).alias("n"))


CSV = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def _dropped(spark: SparkSession, folder: str) -> tuple[str, StructType]:
    path, rows = _folder(spark, "upload"), table(spark, folder, "events")
    rows.write.options(**CSV).csv(path)
    return path, rows.schema


@query
def dropped_files(spark, folder):
    path, schema = _dropped(spark, folder)
    return file_drop_scan(spark, path, schema, **CSV).drop("source_file")


@query
def dropped_files_stream(spark, folder):
    path, schema = _dropped(spark, folder)
    landing = _folder(spark, "landing")

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.drop("source_file").write.mode("overwrite").parquet(f"{landing}/batch={batch_id}")

    load_drops(file_drop_stream(spark, path, schema, **CSV), land, _folder(spark, "seen")).awaitTermination()
    return spark.read.parquet(landing).drop("batch")


@query
def loaded_files(spark, folder):
    """Dropped files, each a load: all orders, one that stops as it mixes divisions, and changes by the orders' status:
    finished ones get another customer, pending ones are deleted. Large files arrive in parts, which are loads too."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    status = F.col("o_orderstatus")
    files = (
        orders.select("o_orderkey", "o_custkey", F.lit("U")),
        orders.where(status != "O").select("o_orderkey", "o_custkey", F.when(status == "F", "L").otherwise("U")),
        orders.where(status != "O").select(
            "o_orderkey", F.when(status == "F", F.col("o_custkey") + 1000000), F.when(status == "F", "U").otherwise("D")
        ),
    )
    base, name = _folder(spark, "files"), f"files_{uuid.uuid4().hex[:12]}"
    for number, rows in enumerate(files):
        # Parts that hold both divisions of the second drop, and times in the order of the drops.
        rows = rows.toDF("o_orderkey", "o_custkey", "process_div")
        spread = rows.repartition(4, F.col("o_orderkey") % 4) if number == 1 else rows
        spread.write.options(**CSV).csv(f"{base}/upload/{number}")
        time.sleep(1)
    system = "create_id string, create_dtt timestamp_ntz, last_upd_id string, last_upd_dtt timestamp_ntz"
    empty = spark.createDataFrame([], f"o_orderkey bigint, o_custkey bigint, {system}")
    create_versioned(empty, name, f"{base}/target", "base")
    bigint = TargetType("bigint")
    spec = LoadSpec("files", (ControlColumn("o_orderkey", bigint, True), ControlColumn("o_custkey", bigint)))
    schema = StructType.fromDDL("o_orderkey string, o_custkey string, process_div string")
    options = {**CSV, "pathGlobFilter": "*.csv"}
    handle = load_batch_as(
        spec, name, CTX, f"{base}/work", f"{base}/target", f"{base}/log", LoadOptions(), f"{base}/error"
    )
    stream = file_drop_stream(spark, f"{base}/upload", schema, **options)
    load_drops(stream, handle, f"{base}/seen").awaitTermination()
    spark.catalog.refreshTable(name)
    # The stopped file is there to be looked at.
    stopped = spark.read.schema(schema).options(**CSV).csv(f"{base}/error/Fatal019")
    loaded = spark.table(name).select("o_orderkey", "o_custkey", F.lit("loaded").alias("state"))
    error = stopped.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), F.lit("error").alias("state"))
    return loaded.unionByName(error)


@query
def archive_and_quarantine(spark, folder):
    error, done = archive_or_quarantine(_checked(spark, folder), _folder(spark, "sides"), [rules.ERRORS])

    def side(path: str) -> DataFrame:
        return spark.read.parquet(path).select("o_orderkey", "error_flg")

    return side(error).unionByName(side(done))


def _target_table(spark: SparkSession, folder: str, parts: list[str]) -> str:
    name = f"target_{uuid.uuid4().hex[:12]}"
    create_versioned(_target(spark, folder), name, _folder(spark, "target"), "base", parts)
    return name


def _loaded(spark: SparkSession, folder: str, parts: list[str]) -> DataFrame:
    return _load_into(spark, folder, _target_table(spark, folder, parts))


def _load_into(spark: SparkSession, folder: str, name: str) -> DataFrame:
    changed = F.lit("2024-02-01 08:00:00").cast("timestamp_ntz")
    source = fixture(spark, folder, "work_orders").withColumn("update_date_time", changed)
    base = _folder(spark, "load")
    load_table(CTX, ORDERS, source, name, f"{base}/work", f"{base}/target", f"{base}/log")
    return doubles(spark.table(name), "o_totalprice")


@query
def loaded_table(spark, folder):
    """A load from source to catalogue table, with its work table, checks and log."""
    return _loaded(spark, folder, [])


@query
def loaded_partitioned_table(spark, folder):
    return _loaded(spark, folder, ["o_orderstatus"])


@query
def loaded_listed_table(spark, folder):
    """The same load into a target that is a list of files: only files that hold a matching key are rewritten."""
    name = f"listed_{uuid.uuid4().hex[:12]}"
    create_listed(_target(spark, folder), name, _folder(spark, "target"), "base", ORDERS.keys, files=16)
    return _load_into(spark, folder, name)


@query
def replaced_table(spark, folder):
    """Full replacement by renaming."""
    target, name = _target(spark, folder), f"live_{uuid.uuid4().hex[:12]}"
    target.write.option("path", _folder(spark, "live")).saveAsTable(name)
    content = merge.replacement_rows(target, fixture(spark, folder, "work_replace"), ORDERS, CTX)
    replace_table(content, name)
    return doubles(spark.table(name), "o_totalprice")


# Unload and split.


@query
def unload_scan(spark, folder):
    rows = table(spark, folder, "events")
    path = _folder(spark, "unload")
    unload_partitioned(rows, path, F.col("ts"))
    days = F.col("dt") >= F.lit(date(2024, 1, 15))
    return external_scan(spark, path, ["event_id", "user_id", "value", "dt"], days)


@query
def quarantine(spark, folder):
    bad, good = quarantine_split(_settled(spark, folder))
    sides = bad.select("o_orderkey", F.lit("error").alias("side"))
    return sides.unionByName(good.select("o_orderkey", F.lit("bk").alias("side")))


# Warehouse.


@query
def build_mart(spark, folder):
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nations = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = table(spark, folder, "customer").join(nations.join(regions, "n_regionkey"), "c_nationkey")
    mart = warehouse.build_mart(
        table(spark, folder, "orders"),
        "o_custkey",
        F.trunc("o_orderdate", "month"),
        {"revenue": F.col("o_totalprice").cast("decimal(18,2)")},
        customers,
        "c_custkey",
        ["r_name", "n_name", "c_mktsegment"],
    )
    return mart.withColumn("revenue", F.col("revenue").cast("double"))


@query
def keep_history(spark, folder):
    return warehouse.keep_history(
        table(spark, folder, "orders"), ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "o_orderdate", ["o_orderkey"]
    )


@query
def extended_history(spark, folder):
    """The same history in three steps: old orders, newer ones, and late ones of all times."""
    orders = table(spark, folder, "orders")
    late, new = F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    shape = (["o_custkey"], ["o_orderstatus", "o_orderpriority"], "o_orderdate", ["o_orderkey"])
    stored = orders.where(~late & ~new)
    history = written(warehouse.keep_history(stored, *shape), "history")
    for step in (orders.where(~late & new), orders.where(late)):
        history = written(warehouse.extend_history(history, stored, step, *shape), "history")
        stored = stored.unionByName(step)
    return history


@query
def evolving_view(spark, folder):
    """A view read before and after its table lost a column and gained another."""
    name, view, place = (f"{n}_{uuid.uuid4().hex[:12]}" for n in ("parties", "seen", "place"))
    columns = {"supplier": {"s_suppkey": "party_id", "s_name": "name"}, "customer": {"c_custkey": "party_id", "c_mktsegment": "segment"}}
    states = []
    for number, (source, names) in enumerate(columns.items()):
        rows = table(spark, folder, source).select(*(F.col(k).alias(v) for k, v in names.items()))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows.write.option("path", _folder(spark, place)).saveAsTable(name)
        if not number:
            warehouse.evolving_view(spark, view, name)
        states.append(written(spark.table(view), "state"))
    return states[0].unionByName(states[1], allowMissingColumns=True)


@query
def late_binding_view(spark, folder):
    def old() -> DataFrame:
        return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"))

    def new() -> DataFrame:
        return table(spark, folder, "customer").select(
            F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        )

    warehouse.late_binding_view(spark, "parties", old, new)
    return spark.table("parties")


@query
def row_level_filter(spark, folder):
    return warehouse.row_level_filter(
        table(spark, folder, "customer"), fixture(spark, folder, "entitlements"), "bi_1", ["c_nationkey"]
    )


@query
def layer_access(spark, folder):
    return warehouse.layer_access(fixture(spark, folder, "requests"))


# Service levels.


@query
def slo_query_p95(spark, folder):
    found = slo.slo_query_p95(fixture(spark, folder, "query_log"))
    return found.withColumn("p95_s", F.round("p95_s", 6))


@query
def slo_scan_p95(spark, folder):
    found = slo.slo_scan_p95(fixture(spark, folder, "query_log"))
    return found.withColumn("p95_bytes", F.round("p95_bytes", 2))


@query
def slo_query_p95_weekly(spark, folder):
    queries = fixture(spark, folder, "query_log").withColumn("week", F.to_date(F.date_trunc("week", "start_ts")))
    return slo.slo_query_p95(queries, by=["week"]).withColumn("p95_s", F.round("p95_s", 6))


@query
def slo_etl_window(spark, folder):
    return slo.slo_etl_window(fixture(spark, folder, "etl_runs"))


AS_OF = datetime(2024, 1, 25, 12)


@query
def slo_etl_window_open(spark, folder):
    """Runs that had not ended, seen from one moment."""
    return slo.slo_etl_window(fixture(spark, folder, "open_runs"), as_of=AS_OF)


@query
def slo_log_complete_expected(spark, folder):
    """With sources that sent nothing."""
    return slo.slo_log_complete(
        table(spark, folder, "events"), "user_id", "ts", date(2024, 1, 1), date(2024, 1, 31), fixture(spark, folder, "expected_users")
    )


@query
def missing_log_days_expected(spark, folder):
    return slo.missing_log_days(
        table(spark, folder, "events"), "user_id", "ts", date(2024, 1, 1), date(2024, 1, 31), fixture(spark, folder, "expected_users")
    )


@query
def abort_trend_calendar(spark, folder):
    """Days, some of them without queries."""
    return slo.abort_trend(fixture(spark, folder, "spring_log"), "day", span=(date(2023, 12, 30), date(2024, 2, 2)))


@query
def alert_response_open(spark, folder):
    """Alerts that were open, with the time until one moment."""
    return slo.alert_response(fixture(spark, folder, "alerts"), as_of=AS_OF)


@query
def rpo_check_open(spark, folder):
    """With the gap since the last snapshot, and with sources that have none."""
    return slo.rpo_check(
        table(spark, folder, "events"), "user_id", "ts", ["event_id"], as_of=AS_OF, expected=fixture(spark, folder, "expected_users")
    )


@query
def slo_log_complete(spark, folder):
    return slo.slo_log_complete(table(spark, folder, "events"), "user_id", "ts", date(2024, 1, 1), date(2024, 1, 31))


@query
def missing_log_days(spark, folder):
    return slo.missing_log_days(table(spark, folder, "events"), "user_id", "ts", date(2024, 1, 1), date(2024, 1, 31))


@query
def abort_trend(spark, folder):
    return slo.abort_trend(fixture(spark, folder, "query_log"))


@query
def abort_trend_weekly(spark, folder):
    return slo.abort_trend(fixture(spark, folder, "query_log"), "week")


@query
def classify_queries(spark, folder):
    return slo.classify_queries(fixture(spark, folder, "query_log")).select("query_id", "reason", "action")


@query
def alert_response(spark, folder):
    return slo.alert_response(fixture(spark, folder, "alerts"))


@query
def log_retention_tier(spark, folder):
    logs = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return slo.log_retention_tier(logs, "day", date(2001, 8, 1))


@query
def stale_keys(spark, folder):
    return slo.stale_keys(table(spark, folder, "events"), "user_id", "ts", date(2024, 4, 29))


@query
def mfa_rate(spark, folder):
    return slo.mfa_rate(fixture(spark, folder, "users"))


@query
def rpo_check(spark, folder):
    return slo.rpo_check(table(spark, folder, "events"), "user_id", "ts", ["event_id"])
