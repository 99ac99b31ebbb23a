"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the partition sizing, skew splitting and broadcast choice.
SHUFFLE_BYTES = 256 * 1024**2
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Some hundred keys reach the files' statistics and Bloom filters one by one, not as one range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


def scale_conf(data_bytes: int) -> dict[str, str]:
    """Settings that follow the size of the data a job reads.

    Run-time re-planning joins small shuffle partitions but cannot cut all of them smaller, so a large job has to
    start with enough. Larger splits keep the number of scan tasks in hand.
    """
    partitions = max(200, -(-data_bytes // SHUFFLE_BYTES))
    split = min(1024, max(128, data_bytes // (100_000 * 1024**2)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split}m",
    }


def build_session(
    app: str = "tidegate", master: str | None = None, data_bytes: int | None = None, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = scale_conf(data_bytes) if data_bytes else {}
    for key, value in {**SESSION_CONF, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a folder of its own; on a cluster it has to be set.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        path = context.getCheckpointDir()
    return path.rstrip("/")


# Folders written in the scope that is open in this thread, if any.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the frames :func:`written` inside the block at its end. Nothing may read them afterwards.

    A scope belongs to its thread: loads that run at once keep each other's frames.
    """
    own: list[str] = []
    outer = _made.set(own)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in own:
            remove_folder(spark, path)
