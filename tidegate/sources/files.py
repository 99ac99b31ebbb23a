"""Dropped files and the Parquet landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files below a folder with length and change time. Contents are not read; empty markers are left out."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return files.select("path", "length", "modificationTime").where(F.col("length") > 0)


def file_drop_scan(
    spark: SparkSession, folder: str, schema: T.StructType, form: str = "csv", glob: str = "*", **options: str
) -> DataFrame:
    """Rows of all dropped files below a folder, with the file each came from in ``source_file``."""
    rows = (
        spark.read.format(form)
        .schema(schema)
        .options(**options)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def land_then_load(rows: DataFrame, path: str) -> DataFrame:
    """Write an extract to the landing and go on from there: the source is read once."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
