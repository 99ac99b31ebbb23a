"""URL rules by host-suffix and path-prefix expressions, joined on short hash prefixes.

Every distinct (host, path) is expanded into the expressions that could be a rule: each suffix of the host at a label
boundary with each prefix of the path whose length some rule has. The expressions meet the rules in an equi-join on the
first 32 bits of a SHA-256 digest; the full digest confirms a match. Longest rule wins (host and path together); among
equally long rules that fit, the longer host, then ``block``.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and gets the default verdict. Rules
with a null or empty host, a null path or an unknown verdict fit nothing. Repeated pages each keep their row. Other
columns of the pages are not used. No rules or no pages: no match, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import written

DEFAULT_VERDICT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no slash, so host and path cannot be confused once joined by a line feed.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; ``rules`` has ``host, path, verdict``."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    known = (
        rules.where("host != '' and path is not null and verdict in ('allow', 'block')")
        .select(lower.alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("rule_verdict"))  # 'block' is the larger of the two
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", F.substring("digest", 1, 8))
    )
    # Written, so that its measured size decides whether it is sent to all tasks or the expressions are dealt.
    known = written(known, "rules")
    # Lengths of rule paths: whole numbers up to the longest url, not a number of rules.
    lengths = sorted(r[0] for r in known.select(F.length("rule_path")).distinct().collect())
    distinct = parsed.where("host != ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]).cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    expressions = (
        distinct.withColumn("host_part", F.explode(suffixes))
        .withColumn("path_part", F.explode(prefixes))
        .withColumn("full", _digest(F.col("host_part"), F.col("path_part")))
        .withColumn("head", F.substring("full", 1, 8))
        .select("host", "path", "full", "head")
    )
    matches = expressions.join(known, F.col("head") == F.col("short")).where("full = digest")
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("total"),
        F.length("rule_host").alias("host_length"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = matches.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
