"""Many dropped files in one pass against the same files one after the other."""

import os
import random
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.test_merge import CTX, SPEC, TARGET
from tidegate.plans import drops
from tidegate.plans.load import LoadOptions, load_table
from tidegate.sinks.listed import create_listed
from tidegate.sinks.replace import create_versioned
from tidegate.sinks.tables import read_log

SCHEMA = "a string, b string, v string, process_div string"


def target_rows(spark):
    old = datetime(2020, 1, 1)
    rows = [(k, date(2024, 1, 1 + k % 3), Decimal(k), "x", "old", old, "old", old) for k in range(12)]
    rows += [(3, date(2024, 1, 1), Decimal(99), "again", "old", old, "old", old), (None, date(2024, 1, 1), None, "y", "old", old, "old", old)]
    return spark.createDataFrame(rows, TARGET)


def random_files(rng, many):
    """Files of updates and deletes, of full replacements, mixed ones, ones without a valid division, faulty rows."""
    files = []
    for _ in range(many):
        kind = rng.choice(["changes"] * 6 + ["full", "mixed", "none", "blank"])
        rows = []
        for _ in range(rng.randrange(1, 14)):
            key = rng.choice([str(rng.randrange(14)), f"0{rng.randrange(9)}", "", "bad"] if rng.random() < 0.3 else [str(rng.randrange(14))])
            day = f"2024-01-0{1 + rng.randrange(3)}" if rng.random() < 0.9 else "2024/1/2"
            value = rng.choice([f"{rng.randrange(500)}.5", "", "x"] if rng.random() < 0.2 else [str(rng.randrange(500))])
            division = {"changes": rng.choice("UUD"), "full": "L", "mixed": rng.choice("UL"), "none": "Z", "blank": ""}[kind]
            if kind == "changes" and rng.random() < 0.05:
                division = "Q"
            rows.append((key, day, value, division))
        files.append(rows)
    return files


def state(spark, name):
    return sorted(map(repr, spark.table(name).collect()))


def lines(spark, root):
    """Log lines by run; the column that names the folder is the run's."""
    rows = spark.read.parquet(root).drop("run", "source", "part", "seq")
    placed = spark.read.parquet(root).select(F.col("run").cast("string"), "seq", *rows.columns)
    return sorted(map(repr, placed.collect()))


@pytest.mark.parametrize("seed, listed", [(1, False), (2, True), (3, False), (4, True)])
def test_one_pass_equals_file_by_file(spark, folder, seed, listed):
    rng = random.Random(seed)
    files = random_files(rng, 9)
    runs = [replace(CTX, tag=f"q-0-{n}") for n in range(len(files))]
    options = LoadOptions(whole_source=True)
    outcome = {}
    for way in ("turn", "once"):
        base, name = f"{folder}/{way}", f"drops_{way}_{seed}"
        if listed:
            create_listed(target_rows(spark), name, f"{base}/target", "v", ["a", "b"], files=3)
        else:
            create_versioned(target_rows(spark), name, f"{base}/target", "v")
        places = (name, f"{base}/work", f"{base}/target", f"{base}/log")
        if way == "turn":
            results = [
                load_table(run, SPEC, spark.createDataFrame(rows, SCHEMA), *places, options)
                for run, rows in zip(runs, files, strict=True)
            ]
        else:
            every = [(f"file:/up/{n}%20x.csv", *row) for n, rows in enumerate(files) for row in rows]
            rng.shuffle(every)
            batch = spark.createDataFrame(every, f"source_file string, {SCHEMA}")
            names = [f"file:/up/{n}%20x.csv" for n in range(len(files))]
            results = drops.load_files(batch, names, runs, SPEC, *places, options)
        spark.catalog.refreshTable(name)
        outcome[way] = results, state(spark, name), lines(spark, f"{base}/log")
    for one, other in zip(*outcome.values(), strict=True):
        assert one == other
    assert {r.status for r in outcome["once"][0]} >= {"loaded"}


def load(spark, folder, files, name="few"):
    spark.sql(f"drop table if exists {name}")
    create_versioned(target_rows(spark), name, f"{folder}/target", "v")
    runs = [replace(CTX, tag=f"q-1-{n}") for n in range(len(files))]
    every = [(str(n), *row) for n, rows in enumerate(files) for row in rows]
    batch = spark.createDataFrame(every, f"source_file string, {SCHEMA}")
    places = (name, f"{folder}/work", f"{folder}/target", f"{folder}/log")
    results = drops.load_files(batch, [str(n) for n in range(len(files))], runs, SPEC, *places)
    spark.catalog.refreshTable(name)
    return results, {(r.a, r.b.day if r.b else None): r for r in spark.table(name).where("a IS NOT NULL").collect()}


def test_deleted_and_inserted_again_is_a_new_row(spark, folder):
    day = "2024-01-02"
    results, rows = load(spark, folder, [[("1", day, "", "D")], [("1", day, "5", "U")], [("4", day, "6", "U")], [("4", day, "", "D"), ("13", day, "", "D")]])
    assert [(r.normal_num, r.error_num) for r in results] == [(1, 0), (1, 0), (1, 0), (1, 1)]
    assert (rows[1, 2].v, rows[1, 2].create_id, rows[1, 2].extra) == (Decimal(5), "ETL", None)
    assert (4, 2) not in rows and rows[7, 2].create_id == "old"
    errors = read_log(spark, f"{folder}/log").where("level = 'Error'").collect()
    assert [(r.message_cd, r.run if "run" in r else None) for r in errors] == [("Error001", None)]


def test_one_write_of_the_target_a_batch(spark, folder):
    files = [[(str(k), "2024-01-01", str(n), "U")] for n in range(40) for k in (0, 3)]
    load(spark, folder, files, "often")
    assert len([n for n in os.listdir(f"{folder}/target") if n.startswith("t-")]) == 1
    runs = [n for n in os.listdir(f"{folder}/log") if n.startswith("run=")]
    assert len(runs) == len(files)


def test_no_files(spark):
    empty = spark.createDataFrame([], f"source_file string, {SCHEMA}")
    assert drops.load_files(empty, [], [], SPEC, "x", "w", "t", "l") == []
