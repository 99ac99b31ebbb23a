"""Work tables, logs, partitioned Parquet and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.model import LOG_SCHEMA, RunContext
from tidegate.session import remove_folder


_VERSION = "v-"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Files and folders in a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def work_path(spark: SparkSession, path: str) -> str | None:
    """The folder with a work table's content: the last version that was written to its end; None before the first."""
    versions = [f"{path}/{name}" for name in _names(spark, path) if name.startswith(_VERSION)]
    return next((v for v in reversed(versions) if "_SUCCESS" in _names(spark, v)), None)


def read_work(spark: SparkSession, path: str) -> DataFrame:
    """A work table's rows, for readers that did not write them."""
    return spark.read.parquet(work_path(spark, path) or path)


def truncate_and_load(rows: DataFrame, path: str) -> DataFrame:
    """Replace a work table's content. All blocks appear at once or not at all.

    The new content is a version folder of its own, which counts from the moment its write has ended; only then the old
    one goes. ``rows`` may read the old content. A write that fails leaves it as it was.
    """
    spark = rows.sparkSession
    before = _names(spark, path)
    number = max((int(n.removeprefix(_VERSION)) for n in before if n.startswith(_VERSION)), default=0) + 1
    fresh = f"{path}/{_VERSION}{number:09d}"
    rows.write.parquet(fresh)
    for name in before:
        remove_folder(spark, f"{path}/{name}")
    return spark.read.schema(rows.schema).parquet(fresh)


def bulk_append(rows: DataFrame, path: str) -> None:
    """Add rows to a work table, or to a plain folder, in one parallel write."""
    rows.write.mode("append").parquet(work_path(rows.sparkSession, path) or path)


def append_log(log: DataFrame, root: str, ctx: RunContext, source: str, part: str) -> None:
    """Add a table's log lines of a run. A repeated run of the same id replaces its own lines."""
    log.write.mode("overwrite").parquet(f"{root}/run={ctx.run_name}/source={source}/part={part}")


def append_logs(log: DataFrame, root: str, source: str, part: str) -> None:
    """:func:`append_log` of many runs in one write; the column ``run`` names each line's run.

    A repeated write replaces the lines of the runs it has lines of.
    """
    placed = log.withColumns({"source": F.lit(source), "part": F.lit(part)}).hint("rebalance", F.col("run"))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run", "source", "part").parquet(root)


_PLACE = ("run", "source", "part")
_PACKED = "_packed"


def _placed_log(spark: SparkSession, root: str) -> DataFrame:
    """All log lines with the run, source and part they belong to.

    Lines lie in a folder of their own or in a packed day. Where a part has a folder, also an empty one, that is what
    counts: a run that was repeated after its day was packed, or a packing that broke off, doubles nothing.
    """
    places = T.StructType([T.StructField(n, T.StringType()) for n in _PLACE])
    schema = T.StructType(LOG_SCHEMA.fields + places.fields)
    loose = spark.read.schema(schema).parquet(root)
    days = [work_path(spark, f"{root}/{_PACKED}/{day}") for day in _names(spark, f"{root}/{_PACKED}")]
    if not any(days):
        return loose
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    taken = files.select(*(F.url_decode(F.regexp_extract("path", f"/{n}=([^/]*)", 1)).alias(n) for n in _PLACE)).distinct()
    packed = spark.read.schema(schema).parquet(*[d for d in days if d])
    return loose.unionByName(packed.join(taken, list(_PLACE), "left_anti").select(loose.columns))


def read_log(spark: SparkSession, root: str, ctx: RunContext | None = None) -> DataFrame:
    rows = _placed_log(spark, root)
    if ctx is not None:
        rows = rows.where(F.col("run") == ctx.run_name)
    return rows.drop(*_PLACE)


def pack_log(spark: SparkSession, root: str, day: date) -> None:
    """Put the many small folders of a finished day's runs together in few files. May be repeated; readers see the same
    lines before, between and after its steps."""
    stamp = day.strftime("%Y%m%d")
    runs = [name for name in _names(spark, root) if name.startswith(f"run={stamp}")]
    if not runs:
        return
    rows = _placed_log(spark, root).where(F.col("run").startswith(stamp))
    truncate_and_load(rows.hint("rebalance"), f"{root}/{_PACKED}/{stamp}")
    for name in runs:
        remove_folder(spark, f"{root}/{name}")


def unload_partitioned(rows: DataFrame, path: str, dt: Column, max_rows_per_file: int = 5_000_000) -> None:
    """Parquet with Snappy by ``dt=YYYY-MM-DD``.

    Rows are rebalanced by day: small days share a task's file, a large day is split over several tasks.
    """
    dated = rows.withColumn("dt", F.date_format(dt, "yyyy-MM-dd"))
    (
        dated.hint("rebalance", F.col("dt"))
        .write.mode("overwrite")
        .partitionBy("dt")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_rows_per_file)
        .parquet(path)
    )


def archive_or_quarantine(work: DataFrame, root: str, drop: Sequence[str] = ()) -> tuple[str, str]:
    """Rows in error go to ``error/``, the others to ``bk/``, in one write."""
    side = F.when(F.col("error_flg"), "error").otherwise("bk").alias("side")
    work.drop(*drop).select("*", side).write.mode("overwrite").partitionBy("side").parquet(root)
    return f"{root}/side=error", f"{root}/side=bk"


def quarantine_split(work: DataFrame) -> tuple[DataFrame, DataFrame]:
    return work.where(F.col("error_flg")), work.where(~F.col("error_flg"))
