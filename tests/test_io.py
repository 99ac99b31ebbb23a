import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegate.model import RunContext
from tidegate.operators.log import run_lines
from tidegate.plans.inventory import run_inventory
from tidegate.sinks import inventory as I
from tidegate.sinks import tables as K
from tidegate.sinks.jdbc import insert_options
from tidegate.session import written
from tidegate.sources.catalog import crawl_schemas, discover_schemas, merge_catalog, merge_crawl
from tidegate.sources.extract import external_scan, sample_extract
from tidegate.sources.files import file_drop_scan, file_listing, land_then_load
from tidegate.sources.jdbc import incremental_options, jdbc_options
from tidegate.streaming.file_drop import file_drop_stream, load_drops
from casebook.fixtures import fixture

FOLDER = "/root/testdata/sf0.001"
CTX = RunContext(datetime(2024, 2, 1, 9, 0, 0))


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "(SELECT 1) X", properties={"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "(SELECT 1) X", "fetchsize": "10000", "user": "u"}
    cut = jdbc_options("jdbc:x", "t", partition_column="at", lower=datetime(2024, 1, 1), upper=datetime(2024, 1, 2), partitions=4)
    assert cut["lowerBound"] == "2024-01-01 00:00:00" and cut["numPartitions"] == "4"
    slices = incremental_options("jdbc:x", "t", CTX, partitions=4)
    assert (slices["partitionColumn"], slices["lowerBound"], slices["upperBound"]) == (
        "update_date_time", "2024-01-31 09:00:00", "2024-02-01 09:00:00",
    )
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="at")


def test_insert_options():
    options = insert_options("jdbc:x", "core.t", properties={"user": "u"}, writers=3)
    assert options == {"url": "jdbc:x", "dbtable": "core.t", "batchsize": "5000", "numPartitions": "3", "user": "u"}


def test_dropped_files(spark, folder):
    os.makedirs(f"{folder}/upload/a")
    for name, text in (("one.csv", "id,n\n1,x\n2,y\n"), ("a/two.csv", "id,n\n3,z\n"), ("a/marker", "")):
        with open(f"{folder}/upload/{name}", "w") as out:
            out.write(text)
    listing = file_listing(spark, f"{folder}/upload").collect()
    assert sorted(os.path.basename(r["path"]) for r in listing) == ["one.csv", "two.csv"]
    schema = spark.createDataFrame([], "id int, n string").schema
    rows = file_drop_scan(spark, f"{folder}/upload", schema, header="true", glob="*.csv")
    assert sorted((r["id"], os.path.basename(r["source_file"])) for r in rows.collect()) == [
        (1, "one.csv"), (2, "one.csv"), (3, "two.csv"),
    ]

    seen = []

    def handle(batch, batch_id):
        batch.write.mode("append").parquet(f"{folder}/out")
        seen.append(batch_id)

    def run():
        stream = file_drop_stream(spark, f"{folder}/upload", schema, archive=f"{folder}/bk", header="true", pathGlobFilter="*.csv")
        load_drops(stream, handle, f"{folder}/checkpoint").awaitTermination(120)

    run()
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2, 3]
    with open(f"{folder}/upload/three.csv", "w") as out:
        out.write("id,n\n4,w\n")
    run()
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2, 3, 4]
    archived = {f for _, _, files in os.walk(f"{folder}/bk") for f in files if f.endswith(".csv")}
    assert archived >= {"one.csv", "two.csv"}


def test_landing_and_append(spark, folder):
    rows = spark.range(10)
    assert land_then_load(rows, f"{folder}/landing").count() == 10
    K.bulk_append(rows, f"{folder}/landing")
    assert spark.read.parquet(f"{folder}/landing").count() == 20
    assert K.truncate_and_load(spark.range(3), f"{folder}/landing").count() == 3
    assert sample_extract(spark.range(5000)).count() == 1000


def test_unload_prunes_days(spark, folder):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    K.unload_partitioned(events, f"{folder}/events", F.col("ts"))
    day = F.col("dt") == F.lit(date(2024, 1, 5))
    scan = external_scan(spark, f"{folder}/events", ["event_id"], day)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<event_id:bigint>" in plan
    assert scan.count() == events.where("to_date(ts) = date'2024-01-05'").count()
    files = [f for d, _, fs in os.walk(f"{folder}/events") for f in fs if f.endswith(".parquet")]
    assert files and all(".snappy." in f for f in files)


def test_large_day_is_split(spark, folder):
    rows = spark.range(1000).select("id", F.lit(datetime(2024, 1, 1)).alias("ts"))
    K.unload_partitioned(rows, f"{folder}/one", F.col("ts"), max_rows_per_file=100)
    assert len([f for f in os.listdir(f"{folder}/one/dt=2024-01-01") if f.endswith(".parquet")]) >= 10


def test_quarantine_sink(spark, folder):
    work = spark.range(10).withColumn("error_flg", F.col("id") < 3)
    error, done = K.archive_or_quarantine(work, f"{folder}/q")
    assert (spark.read.parquet(error).count(), spark.read.parquet(done).count()) == (3, 7)


def test_inventory_files(spark, folder):
    frames = [fixture(spark, FOLDER, n) for n in ("meta_objects", "meta_tables", "meta_columns")]
    path = run_inventory(*frames, f"{folder}/inventory", CTX)
    assert path.endswith("/run_dt=20240201_090000")
    for name in ("schemas", "tables", "columns"):
        assert [f for f in os.listdir(f"{path}/{name}") if f.endswith(".csv")]
    back = spark.read.option("header", True).csv(f"{path}/schemas")
    assert back.columns == ["owner", "total_objects", "tables", "views"] and back.count() > 0


def test_inventory_in_files_of_its_tasks(spark, folder):
    I.write_inventory_csv(spark.range(0, 100, 1, 4).select("id"), f"{folder}/big")
    assert len([f for f in os.listdir(f"{folder}/big") if f.endswith(".csv")]) == 4


def test_catalogue(spark, folder):
    spark.range(1).select("id", F.lit("x").alias("n")).write.parquet(f"{folder}/d1")
    known = discover_schemas(spark, {"d1": f"{folder}/d1", "d2": lambda: spark.range(1)})
    assert [(r["dataset"], r["ordinal"], r["column"], r["type"]) for r in known.orderBy("dataset", "ordinal").collect()] == [
        ("d1", 1, "id", "bigint"), ("d1", 2, "n", "string"), ("d2", 1, "id", "bigint"),
    ]
    spark.range(1).select(F.col("id").cast("int"), F.lit(1.5).alias("v")).write.parquet(f"{folder}/d1b")
    found = discover_schemas(spark, {"d1": f"{folder}/d1b", "d2": lambda: spark.range(1)})
    states = {(r["dataset"], r["column"]): r["state"] for r in merge_catalog(known, found).collect()}
    assert states == {("d1", "id"): "changed", ("d1", "n"): "gone", ("d1", "v"): "added", ("d2", "id"): "same"}


def test_failed_write_leaves_the_old_rows(spark, folder):
    path = f"{folder}/work"
    assert K.work_path(spark, path) is None
    first = K.truncate_and_load(spark.range(5), path)
    half = spark.range(0, 100, 1, 4).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        K.truncate_and_load(half, path)
    assert first.count() == K.read_work(spark, path).count() == 5
    # The next write may read what it replaces, and clears what the failed one left.
    doubled = K.truncate_and_load(first.select((F.col("id") * 2).alias("id")), path)
    assert sorted(r.id for r in doubled.collect()) == [0, 2, 4, 6, 8]
    K.bulk_append(spark.range(100, 102), path)
    assert K.read_work(spark, path).count() == 7
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 1


def test_packed_logs_read_the_same(spark, folder, monkeypatch):
    root, day = f"{folder}/log", datetime(2024, 2, 1, 9)
    runs = [RunContext(day, tag=f"r{n}") for n in range(3)] + [RunContext(datetime(2024, 2, 2, 9))]

    def line(text):
        return run_lines(spark, runs[0], [{"code": "Info001", "message": text, "seq": 1}])

    def texts():
        return sorted(r.message.split("] ")[-1] for r in K.read_log(spark, root).collect())

    def files(below=""):
        return sum(f.endswith(".parquet") for _, _, names in os.walk(f"{root}/{below}") for f in names)

    for n, run in enumerate(runs):
        for source in "abc":
            for part in ("errors", "lines"):
                K.append_log(line(f"{n}{source}{part}"), root, run, source, part)
    before = texts()
    assert len(before) == 24 and files() >= 24
    with monkeypatch.context() as broken:  # a packing that ends before the folders are gone
        broken.setattr(K, "remove_folder", lambda *_: None)
        K.pack_log(spark, root, day.date())
        assert texts() == before
    K.pack_log(spark, root, day.date())
    assert texts() == before and K.read_log(spark, root, runs[1]).count() == 6
    assert files("_packed") <= 2 and sorted(os.listdir(root)) == ["_packed", f"run={runs[3].run_name}"]
    # A run written again counts once, with its new lines, be they none.
    K.append_log(line("new"), root, runs[0], "a", "lines")
    K.append_log(line("x").limit(0), root, runs[0], "b", "lines")
    after = texts()
    assert len(after) == 23 and sum("new" in t for t in after) == 1
    K.pack_log(spark, root, day.date())
    assert texts() == after
    K.pack_log(spark, root, date(2030, 1, 1))


TABLES_OF = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_tasks_read_the_schemas_that_the_reader_reads(spark, folder):
    K.unload_partitioned(spark.read.parquet(f"{FOLDER}/events.parquet"), f"{folder}/days", F.col("ts"))
    kinds = spark.sql(
        "select 1Y a, 2S b, 1.5f c, cast(2 as decimal(9,3)) d, timestamp'2024-01-01' e, timestamp_ntz'2024-01-01' f, map('k', 1) g,"
        " array(struct(1 as x, 'y' as y)) h, cast('z' as binary) i, true j, null k"
    ).drop("k")
    kinds.write.parquet(f"{folder}/kinds")
    paths = {t: f"{FOLDER}/{t}.parquet" for t in TABLES_OF.split()}
    paths |= {"days": f"{folder}/days", "kinds": f"file://{folder}/kinds"}
    got = {}
    for r in crawl_schemas(spark.createDataFrame(list(paths.items()), "dataset string, path string")).collect():
        assert r.failure is None and r.nullable
        got.setdefault(r.dataset, {})[r.ordinal] = (r.column, r.type)
    for name, path in paths.items():
        assert [got[name][i] for i in sorted(got[name])] == spark.read.parquet(path).dtypes, name


def test_crawl_of_thousands(spark, folder):
    import pyarrow as pa
    import pyarrow.parquet as pq

    many = 4_000
    for n in range(many):
        os.makedirs(f"{folder}/many/d{n}")
        pq.write_table(pa.table({"id": pa.array([n]), f"c{n % 7}": pa.array(["x"])}), f"{folder}/many/d{n}/part.parquet")
    paths = spark.range(many).select(
        F.format_string("d%d", "id").alias("dataset"), F.format_string(f"{folder}/many/d%d", "id").alias("path")
    )
    found = written(crawl_schemas(paths), "found")
    assert found.count() == 2 * many and found.where("failure is not null").isEmpty()
    known = found.drop("failure").where("dataset <> 'd5'").withColumn(
        "type", F.when((F.col("dataset") == "d9") & (F.col("column") == "id"), "int").otherwise(F.col("type"))
    )
    merged = merge_crawl(known, found.drop("failure"))
    states = {r.state: r["count"] for r in merged.groupBy("state").count().collect()}
    assert states == {"same": 2 * many - 3, "added": 2, "changed": 1}
    assert sorted(map(str, merged.collect())) == sorted(map(str, merge_catalog(known, found.drop("failure")).collect()))


def test_datasets_that_cannot_be_read_are_told(spark, folder):
    rows = spark.createDataFrame([("gone", f"{folder}/gone"), ("odd", "nostore://x/y")], "dataset string, path string")
    got = {r.dataset: r for r in crawl_schemas(rows).collect()}
    assert {r.ordinal for r in got.values()} == {0} and all(r.failure for r in got.values())
    with pytest.raises(Exception, match="gone"):
        discover_schemas(spark, {"gone": f"{folder}/gone"})
