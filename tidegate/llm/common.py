"""Helpers that several operators share: shipping the package to executors, byte-bounded slices, connected groups."""

from __future__ import annotations

import ctypes
import functools
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import written

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

SLICE_BYTES = 4 * 1024**2
"""Text handled at once inside a task; a longer single text is handled alone."""


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000
"""Most rows of an Arrow batch in a session that runs these operators, as texts are long."""


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per Spark context, and bound the session's Arrow batches."""
    context = spark.sparkContext
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS or int(spark.conf.get(_BATCH)) <= 0:
        spark.conf.set(_BATCH, BATCH_ROWS)
    if getattr(context, "_tidegate_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="run-")), "tidegate_modules.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(os.path.join(root, "tidegate")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, root))
    context.addPyFile(path)
    context._tidegate_shipped = True


def tidy(step: Step) -> Step:
    """A step that gives its free memory back at the end of a task: workers are kept for later ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform.startswith("linux"):
            ctypes.CDLL(None).malloc_trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as they are, also with dots or back quotes in them."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def any_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose first argument may have columns with dots or back quotes in their names.

    Spark's Arrow steps cannot address these, so they have other names inside and get their own back in the result.
    """

    @functools.wraps(operator)
    def run(documents: DataFrame, *args, **kwargs) -> DataFrame:
        names = documents.columns
        other = {c: unused(f"column_{n}", names) for n, c in enumerate(names) if "." in c or "`" in c}
        out = operator(documents.withColumnsRenamed(other), *args, **kwargs)
        return out.withColumnsRenamed({new: old for old, new in other.items()})

    return run


def unused(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no name taken is the same in any case."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def by_bytes(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``limit`` bytes each."""
    start = total = 0
    for row, size in enumerate(text_sizes(column)):
        if total and total + size > limit:
            yield start, row
            start, total = row, 0
        total += size
    if start < len(column):
        yield start, len(column)


def text_sizes(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text, None for null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Large-star and small-star rounds in turn until no edge changes. Neighbour lists are never gathered: each round
    is one minimum per node (combined before the shuffle) and one join, and its result is a written table.
    """
    links = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    for _ in range(max_rounds):
        links = _small_star(_large_star(links))
        links = written(links, "links")
        # Stars are stable when every edge points at a root: neither the edges nor their sum change any more.
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("m", "a").alias("m"))
    # A written side lets run-time planning split a node with very many neighbours.
    joined = both.join(written(lowest, "lowest"), F.col("a") == F.col("k"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, are linked to the smallest of them."""
    lowest = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    lowest = written(lowest, "lowest")
    joined = links.join(lowest, F.col("a") == F.col("k"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = lowest.select(F.col("k").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).where("a != b").distinct()
