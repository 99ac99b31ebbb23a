"""Targets that are a list of files: a load writes the files it changes and new ones, and nothing else.

Such a target is a catalogue view over version folders that leaves out, by name, the files that no longer count; filters and
column choices of a reader go through it to the files. One replacement of the view switches a whole load at once, and a
load that fails before it leaves the target as it was. Next to the versions lies the list of all files with their sizes and
the range of the first key column; files are written in key order and hold Parquet's own Bloom filters on the key columns.

A load leaves out files in two steps: those whose range meets none of the wanted keys (the keys are summed up as some
hundred ranges), then, while reading only the key columns of the others, row groups by statistics and Bloom filters if the
keys are few enough to be literals. What is left decides exactly which files hold a wanted key. Leaving files out never
changes a result. The driver holds the list, one entry a file, as Spark's own file index does.

Every load adds a folder. Beyond ``max_folders`` the smallest ones are rewritten with the next load, so that the view stays short.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.model import LoadSpec, RunContext
from tidegate.operators import keys as key_checks
from tidegate.operators import merge
from tidegate.session import remove_folder, written

FILE_BYTES = 256 * 1024**2
"""Size that new files are meant to have."""

FILE_ROWS = 1_000_000
"""Most rows a new file is meant to have: a file is sorted in one task, whose memory this bounds."""

MAX_FOLDERS = 64
RANGES = 200
"""Ranges that the wanted keys are summed up as."""

LITERAL_KEYS = 1_000
"""Up to so many keys are given to the file reader as literals; more are joined only."""

_LIST, _KEY = "tidegate.list", "tidegate.key"


@dataclass(frozen=True)
class File:
    folder: str
    name: str
    live: bool
    row_cnt: int
    byte_cnt: int
    low: object
    high: object

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}"


@dataclass(frozen=True)
class Listing:
    """A target's files, those left out of it included while their folder is in use."""

    path: str
    key: str | None
    files: tuple[File, ...]

    @property
    def live(self) -> list[File]:
        return [f for f in self.files if f.live]


def create_listed(rows: DataFrame, table: str, root: str, version: str, keys: Sequence[str], files: int = 1) -> None:
    """A new target with the given rows, in about ``files`` files."""
    key = keys[0] if keys else None
    folder, found = _write(rows, root, version, keys, _files(files, rows.count()))
    _point(rows.sparkSession, table, rows.schema, found, key, root, folder)


def is_listed(spark: SparkSession, table: str) -> bool:
    return _LIST in _properties(spark, table)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def listing(spark: SparkSession, table: str) -> Listing:
    noted = _properties(spark, table)
    rows = spark.read.parquet(noted[_LIST]).collect()
    return Listing(noted[_LIST], noted.get(_KEY), tuple(File(*r) for r in rows))


def read_files(spark: SparkSession, schema: T.StructType, files: Iterable[File]) -> DataFrame:
    paths = [f.path for f in files]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- leaving files out


def key_ranges(keys: DataFrame, key: str) -> list[tuple]:
    """Disjoint ranges, in order, that together hold every value of a column and little else."""
    values = keys.select(F.col(f"`{key}`").alias("value")).where("value IS NOT NULL")
    cut = values.repartitionByRange(RANGES, "value").groupBy(F.spark_partition_id().alias("part"))
    return sorted((_plain(r["low"]), _plain(r["high"])) for r in cut.agg(F.min("value").alias("low"), F.max("value").alias("high")).collect())


def _plain(value: object) -> object:
    # Rounding keeps the order, and ranges are closed: no range is missed.
    return float(value) if isinstance(value, Decimal) else value


def meeting(files: Iterable[File], ranges: Sequence[tuple]) -> list[File]:
    """The files whose key range meets one of the ranges. A file without keys meets none."""
    tops = [high for _, high in ranges]
    out = []
    for file in files:
        if file.low is None:
            continue
        try:
            at = bisect_left(tops, _plain(file.low))
            hit = at < len(ranges) and ranges[at][0] <= _plain(file.high)
        except TypeError:  # keys of another kind than the target's are left to the join
            hit = True
        if hit:
            out.append(file)
    return out


def holding(spark: SparkSession, schema: T.StructType, files: Sequence[File], wanted: DataFrame, keys: Sequence[str]) -> list[File]:
    """The files that hold one of the ``wanted`` keys (distinct rows of ``keys``), exactly."""
    if not files:
        return []
    rows = read_files(spark, schema, files).select(*(F.col(f"`{k}`") for k in keys), F.col("_metadata.file_name").alias("__file"))
    few = wanted.select(F.col(f"`{keys[0]}`")).distinct().limit(LITERAL_KEYS + 1).collect()
    if len(few) <= LITERAL_KEYS:
        rows = rows.where(F.col(f"`{keys[0]}`").isin([r[0] for r in few if r[0] is not None]))
    found = rows.join(wanted, list(keys), "left_semi").select("__file").distinct()
    names = {r[0] for r in found.collect()}  # no more than files
    return [f for f in files if f.name in names]


def for_deletes(spark: SparkSession, table: str, staged: DataFrame, spec: LoadSpec) -> DataFrame:
    """The target's rows in files that may hold a staged delete's key: all that the check of deletes needs to see."""
    found, schema = listing(spark, table), spark.table(table).schema
    if not spec.keys or found.key != spec.keys[0]:
        return spark.table(table)
    typed = staged.select(key_checks.delete_keys(spec)["__key0"].alias("__key0"))
    return read_files(spark, schema, meeting(found.live, key_ranges(typed, "__key0")))


# ---------------------------------------------------------------- writing


def merge_listed(
    table: str, work: DataFrame, spec: LoadSpec, ctx: RunContext, root: str, version: str, keep_old: bool = True,
    max_folders: int = MAX_FOLDERS, file_bytes: int = FILE_BYTES,
) -> None:
    """Update, insert and delete in place of the files that hold a matching key; new rows go to new files.

    Same rows as :func:`merge.merge_work` gives for the whole target.
    """
    spark = work.sparkSession
    found, schema = listing(spark, table), spark.table(table).schema
    rows = merge.applied(work, spark.createDataFrame([], schema), spec, ctx)
    touched: list[File] = []
    if spec.keys:
        wanted = written(rows.select(*spec.keys).distinct(), "wanted")
        near = meeting(found.live, key_ranges(wanted, spec.keys[0])) if found.key == spec.keys[0] else found.live
        touched = holding(spark, schema, near, wanted, spec.keys)
    touched = list(dict.fromkeys(touched + _foldable(found.live, max_folders)))
    old = read_files(spark, schema, touched)
    content = merge.merge_work(old, work, spec, ctx)
    share = sum(f.byte_cnt for f in found.live) / max(1, sum(f.row_cnt for f in found.live))
    new = rows.count()
    size = sum(f.byte_cnt for f in touched) + share * new
    files = _files(round(size / file_bytes), sum(f.row_cnt for f in touched) + new)
    _replace(spark, table, schema, found, touched, content, spec, root, version, keep_old, files)


def replace_listed(
    table: str, work: DataFrame, spec: LoadSpec, ctx: RunContext, root: str, version: str, keep_old: bool = True,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Full replacement."""
    spark = work.sparkSession
    found, schema = listing(spark, table), spark.table(table).schema
    content = merge.replacement_rows(spark.createDataFrame([], schema), work, spec, ctx)
    share = sum(f.byte_cnt for f in found.live) / max(1, sum(f.row_cnt for f in found.live))
    new = work.count()
    files = _files(round(share * new / file_bytes), new)
    _replace(spark, table, schema, found, found.live, content, spec, root, version, keep_old, files)


def _files(by_size: int, row_cnt: int) -> int:
    """Files for so many rows: as by size, but no more than ``FILE_ROWS`` rows in one."""
    return max(1, by_size, -(-row_cnt // FILE_ROWS))


def _foldable(live: Sequence[File], max_folders: int) -> list[File]:
    """Files of the smallest folders, so many that half of the allowed number is left, once there are too many."""
    folders: dict[str, list[File]] = {}
    for file in live:
        folders.setdefault(file.folder, []).append(file)
    if len(folders) < max_folders:
        return []
    by_size = sorted(folders.values(), key=lambda own: (sum(f.byte_cnt for f in own), own[0].folder))
    return [f for own in by_size[: len(by_size) - max_folders // 2] for f in own]


def _replace(
    spark: SparkSession, table: str, schema: T.StructType, found: Listing, gone: Sequence[File], content: DataFrame,
    spec: LoadSpec, root: str, version: str, keep_old: bool, files: int,
) -> None:
    folder, new = _write(content, root, version, spec.keys, files)
    left = set(gone)
    marked = [replace(f, live=f.live and f not in left) for f in found.files] + new
    used = {f.folder for f in marked if f.live}
    _point(spark, table, schema, [f for f in marked if f.folder in used], found.key, root, folder)
    if not keep_old:
        for old in sorted({f.folder for f in found.files} - used):
            remove_folder(spark, old)
        remove_folder(spark, found.path)


def _write(rows: DataFrame, root: str, version: str, keys: Sequence[str], files: int) -> tuple[str, list[File]]:
    """Write a folder in key order; its files as they are listed."""
    spark, folder = rows.sparkSession, f"{root}/{version}-{uuid.uuid4().hex[:8]}"
    kinds = {f.name.lower(): f.dataType for f in rows.schema.fields}
    by_key = [F.col(f"`{k}`") for k in keys]
    laid = rows.repartitionByRange(files, *by_key).sortWithinPartitions(*by_key) if keys else rows
    writer = laid.write.option("parquet.bloom.filter.adaptive.enabled", "true")
    for key in keys:
        if not isinstance(kinds[key.lower()], T.BooleanType):
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(folder)
    first = F.col(f"`{keys[0]}`") if keys else F.lit(None).cast("string")
    per_file = spark.read.schema(rows.schema).parquet(folder).groupBy(
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("byte_cnt")
    )
    found = per_file.agg(F.count(F.lit(1)).alias("row_cnt"), F.min(first).alias("low"), F.max(first).alias("high")).collect()
    return folder, [File(folder, r["name"], True, r["row_cnt"], r["byte_cnt"], r["low"], r["high"]) for r in found]


def _point(
    spark: SparkSession, table: str, schema: T.StructType, files: Sequence[File], key: str | None, root: str, newest: str
) -> None:
    """Write the list, then make the view of it, in one catalogue step."""
    path = f"{root}/_lists/{table}-{uuid.uuid4().hex[:8]}"
    kind = next((f.dataType for f in schema.fields if key and f.name.lower() == key.lower()), T.StringType())
    entry = T.StructType.fromDDL("folder string, name string, live boolean, row_cnt long, byte_cnt long")
    entry = entry.add("low", kind).add("high", kind)
    rows = [tuple(getattr(f, n) for n in entry.fieldNames()) for f in files]
    spark.createDataFrame(rows, entry).coalesce(1).write.parquet(path)
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    parts = []
    for folder, own in groupby(sorted(files, key=lambda f: (f.folder, f.name)), key=lambda f: f.folder):
        dead = ", ".join(f"'{f.name}'" for f in own if not f.live)
        source = folder.replace("`", "``")
        parts.append(f"SELECT {columns} FROM parquet.`{source}`" + (f" WHERE _metadata.file_name NOT IN ({dead})" if dead else ""))
    if not parts:  # a target without rows: the newest folder has a file without rows
        parts.append(f"SELECT {columns} FROM parquet.`{newest}`")
    noted = {_LIST: path, **({_KEY: key} if key else {})}
    quoted = ", ".join(f"'{k}' = '{_literal(v)}'" for k, v in noted.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({quoted}) AS " + " UNION ALL ".join(parts))


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
