"""Column catalogue of datasets.

Paths are rows: tasks read the footer of one file of each dataset and return its columns, so that thousands of datasets cost
the driver nothing but their names. Where a dataset's schema has the digest it had before, its columns stay out of the merge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import written

CATALOG_SCHEMA = "dataset string, ordinal int, column string, type string, nullable boolean"
_KEY = ("dataset", "column")

DATASETS_PER_TASK = 50


def _footers() -> Callable:
    """The step that reads footers. It stands for itself: executors need not have this package."""

    def step(batches: Iterator) -> Iterator:
        import json
        import re
        from urllib.parse import unquote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import StructType

        noted_by_spark = b"org.apache.spark.sql.parquet.row.metadata"

        def first_file(path: str) -> tuple:
            if re.match("file:/", path):
                path = "/" + unquote(path[5:]).lstrip("/")
            store, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
            if store.get_file_info(place).type == fs.FileType.File:
                return store, place, ""
            files = sorted(
                f.path for f in store.get_file_info(fs.FileSelector(place, recursive=True))
                if f.type == fs.FileType.File and not any(p[:1] in "_." for p in f.path[len(place) :].strip("/").split("/"))
            )
            return store, files[0], files[0][len(place) :]

        def kind_of(value: str) -> str:
            if re.fullmatch("-?[0-9]{1,9}", value):
                return "int"
            return "date" if re.fullmatch("[0-9]{4}-[0-9]{2}-[0-9]{2}", value) else "string"

        def columns(path: str) -> list[tuple]:
            store, place, inner = first_file(path)
            with store.open_input_file(place) as source:
                schema = pq.read_schema(source)
            noted = (schema.metadata or {}).get(noted_by_spark)
            fields = StructType.fromJson(json.loads(noted)) if noted else from_arrow_schema(schema, prefer_timestamp_ntz=True)
            parts = dict(p.split("=", 1) for p in inner.split("/")[:-1] if "=" in p)
            own = [(f.name, f.dataType.simpleString()) for f in fields if f.name not in parts]
            return own + [(k, kind_of(unquote(v))) for k, v in parts.items()]

        for batch in batches:
            rows: list[tuple] = []
            for dataset, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = columns(path)
                except Exception as failure:  # noqa: BLE001 - told in the row; the caller decides
                    rows.append((dataset, 0, None, None, None, f"{type(failure).__name__}: {failure}"))
                    continue
                rows += [(dataset, i, name, kind, True, None) for i, (name, kind) in enumerate(found, 1)]
            names = ["dataset", "ordinal", "column", "type", "nullable", "failure"]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string()]
            arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return step


def crawl_schemas(paths: DataFrame) -> DataFrame:
    """One row per column of every Parquet dataset in ``paths`` (``dataset, path``), read by tasks.

    A dataset that a task cannot read has one row, with ordinal 0 and the reason in ``failure``.
    """
    spread = paths.select("dataset", "path").repartition(max(1, -(-paths.count() // DATASETS_PER_TASK)))
    return spread.mapInArrow(_footers(), f"{CATALOG_SCHEMA}, failure string")


def discover_schemas(
    spark: SparkSession, datasets: Mapping[str, str | Callable[[], DataFrame]], threads: int = 16
) -> DataFrame:
    """One row per column of each dataset (a Parquet path or a reader). Only footers or catalogues are read.

    Paths are visited by tasks. Readers, which exist on the driver only, and datasets in stores that tasks cannot open are
    visited from the driver, side by side.
    """
    paths = [(name, source) for name, source in sorted(datasets.items()) if not callable(source)]
    crawled = None
    if paths:
        crawled = written(crawl_schemas(spark.createDataFrame(paths, "dataset string, path string")), "crawled")
        failed = {r["dataset"] for r in crawled.where("ordinal = 0").select("dataset").collect()}
        crawled = crawled.where("ordinal > 0").drop("failure")
    else:
        failed = set()

    def columns(item: tuple[str, str | Callable[[], DataFrame]]) -> list[tuple]:
        name, source = item
        frame = source() if callable(source) else spark.read.parquet(source)
        return [
            (name, i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(frame.schema.fields, start=1)
        ]

    others = sorted((n, s) for n, s in datasets.items() if callable(s) or n in failed)
    if not others and crawled is not None:
        return crawled
    with ThreadPoolExecutor(max_workers=threads) as pool:
        found = [row for rows in pool.map(columns, others) for row in rows]
    seen = spark.createDataFrame(found, CATALOG_SCHEMA)
    return seen if crawled is None else crawled.unionByName(seen)


def schema_digests(catalog: DataFrame) -> DataFrame:
    """``dataset, digest``: one text for all columns of a dataset with their order, types and nullability."""
    column = F.struct("ordinal", "column", "type", "nullable")
    return catalog.groupBy("dataset").agg(F.sha2(F.to_json(F.sort_array(F.collect_list(column))), 256).alias("digest"))


def merge_crawl(known: DataFrame, found: DataFrame) -> DataFrame:
    """:func:`merge_catalog`, in which only datasets of another digest are compared column by column."""
    same = schema_digests(known).join(schema_digests(found), ["dataset", "digest"], "left_semi").select("dataset")
    same = written(same, "same")
    kept = found.join(same, "dataset", "left_semi").select(*known.columns).withColumn("state", F.lit("same"))
    rest = (rows.join(same, "dataset", "left_anti") for rows in (known, found))
    return kept.unionByName(merge_catalog(*rest))


def merge_catalog(known: DataFrame, found: DataFrame) -> DataFrame:
    """The catalogue after a crawl, with ``state``: added, changed, same or gone."""
    old, new = known.alias("o"), found.alias("n")
    same = (F.col("o.dataset") == F.col("n.dataset")) & (F.col("o.column") == F.col("n.column"))
    joined = old.join(new, same, "full_outer")
    unchanged = F.lit(True)
    for name in ("ordinal", "type", "nullable"):
        unchanged = unchanged & F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    state = (
        F.when(F.col("o.column").isNull(), "added")
        .when(F.col("n.column").isNull(), "gone")
        .when(unchanged, "same")
        .otherwise("changed")
    )
    values = [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in known.columns]
    return joined.select(*values, state.alias("state"))
