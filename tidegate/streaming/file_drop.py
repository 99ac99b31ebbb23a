"""Loading dropped files as they arrive.

The file source remembers in its checkpoint which files it has seen, so each file is loaded once, also after a
restart, and it moves finished files to the ``bk`` folder by itself. A file is a load of its own, whatever files share
its micro-batch: its checks see its rows only, files count in the order they arrived, and one whose load stops goes to the
``error`` folder while its neighbours are loaded. The files of a batch are read, checked and merged in one pass
(``plans/drops.py``). A failure that may pass repeats the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegate.model import LoadSpec, RunContext
from tidegate.plans.drops import load_files
from tidegate.plans.load import LoadOptions


def file_drop_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    form: str = "csv",
    archive: str | None = None,
    files_per_batch: int = 1000,
    **options: str,
) -> DataFrame:
    reader = spark.readStream.format(form).schema(schema).options(**options)
    reader = reader.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    # A repeated batch may have moved a file to the error folder already.
    reader = reader.option("ignoreMissingFiles", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select("*", F.col("_metadata.file_path").alias("source_file"))


def load_batch_as(
    spec: LoadSpec,
    target_table: str,
    ctx: RunContext,
    work_root: str,
    target_root: str,
    log_root: str,
    options: LoadOptions,
    error: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A handler that loads the files of a micro-batch into a target: each checked and logged as a run of its own, all
    applied together.

    Files whose load stops go to ``error/<code>``. Merging the same rows again changes nothing, so a batch repeated after a
    failure is harmless. Batches run in a session of their own: a session that has read the table before has to refresh it.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "drops"
        # At most files_per_batch names.
        files = _in_order(spark, [r[0] for r in batch.select("source_file").distinct().collect()])
        runs = [replace(ctx, tag=f"{query}-{batch_id}-{number}") for number in range(len(files))]
        results = load_files(batch, files, runs, spec, target_table, work_root, target_root, log_root, options)
        if error:
            for file, result in zip(files, results, strict=True):
                if not result.good:
                    _move(spark, unquote(file), f"{error}/{result.status}")

    return handle


def _in_order(spark: SparkSession, files: list[str]) -> list[str]:
    """Files that are still there, by the time they were written, then by name: the order across batches as well."""
    found = []
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(unquote(file))
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(path):
            found.append((system.getFileStatus(path).getModificationTime(), file))
    return [f for _, f in sorted(found)]


def _move(spark: SparkSession, file: str, folder: str) -> None:
    path, place = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (file, folder))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place)
    system.rename(path, spark._jvm.org.apache.hadoop.fs.Path(place, path.getName()))


def load_drops(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand all waiting files to ``handle`` in micro-batches, then stop. ``handle`` must accept a repeated batch id."""
    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
