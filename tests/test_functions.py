import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import conditions as C
from tidegate.functions import convert as V
from tidegate.functions import text as X
from tidegate.model import RunContext, TargetType
from tidegate.session import scale_conf

CTX = RunContext(datetime(2024, 2, 1, 9, 0, 0), "c1", 24)


def values(spark, texts, make):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    return [r[0] for r in frame.orderBy("i").select(make(F.col("t"))).collect()]


def test_int(spark):
    texts = [None, "", "12", "-3", "1.5", "-1.9", "abc", "1e3", " 7", "7\n", "007", "32768", "-32768", "１２"]
    assert values(spark, texts, lambda t: V.to_int(t, "smallint")) == [
        None, None, 12, -3, 1, -1, 0, 0, 0, 0, 7, None, -32768, 0,
    ]
    limits = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "99999999999999999999"]
    assert values(spark, limits, V.to_int) == [2**63 - 1, None, -(2**63), None]


def test_decimal(spark):
    texts = [None, "", "1.005", "-1", "x", "12345", "1234", ".5", "5."]
    found = values(spark, texts, lambda t: V.to_decimal(t, 6, 2))
    assert found == [None, None, Decimal("1.01"), Decimal("-1.00"), Decimal("0.00"), None, Decimal("1234.00"), 0, 0]
    assert values(spark, ["5", ""], lambda t: V.to_decimal(t, 6, 2, F.lit(True))) == [Decimal("0.00"), None]
    wide = spark.range(1).select(V.to_decimal(F.lit("999999999999999999"), 18, 0).alias("d"))
    assert wide.schema["d"].dataType == T.DecimalType(19, 0)


def test_float_bool_string(spark):
    assert values(spark, ["", "1.5", "x", "-2", None], V.to_float) == [None, 1.5, 0.0, -2.0, None]
    assert values(spark, ["TRUE", "True", "true", "tRUE", "t", "FALSE", "", None], V.to_bool) == [
        True, True, True, None, None, False, None, None,
    ]
    assert values(spark, ["a\nb", "a\r\nb", "", None], V.to_string) == ["a\r\nb", "a\r\r\nb", None, None]


def test_dates(spark):
    texts = ["2024-02-29", "2023-02-29", "1996/2/9", "19970704", "2024-01-05 10:11:12", "2024-1", "", None]
    assert values(spark, texts, V.to_date) == [
        date(2024, 2, 29), None, date(1996, 2, 9), date(1997, 7, 4), date(2024, 1, 5), None, None, None,
    ]
    moments = ["2024-01-05T10:11", "2024-01-05 101112.5", "2024-01-05", "2024-01-05 24:00:00", "2024-01-05 10:11:12+09:00"]
    assert values(spark, moments, V.to_timestamp) == [
        datetime(2024, 1, 5, 10, 11), datetime(2024, 1, 5, 10, 11, 12, 500000), datetime(2024, 1, 5), None,
        datetime(2024, 1, 5, 10, 11, 12),
    ]


def test_typed_key(spark):
    assert values(spark, ["7", "1.0", "abc", ""], lambda t: V.typed_key(t, TargetType("int4"))) == [7, None, None, None]
    assert values(spark, ["7.50", "x"], lambda t: V.typed_key(t, TargetType("numeric", 9, 2))) == [7.5, None]


@pytest.mark.parametrize(
    "make, good, bad",
    [
        (C.bad_int, ["", "1", "-1", "007", None], ["1.5", "x", "+1", "1\n", " 1"]),
        (C.bad_decimal, ["", "1", "-1.5", None], ["1.", ".5", "1e3", "1,5", "1.5\n"]),
        (C.bad_bool, ["", "True", "FALSE", None], ["yes", "t", "1"]),
        (C.not_single_byte, ["", "a ~", None], ["é", "日", "a\tb", "a\n"]),
        (C.bad_date, ["", "2024-02-29", "1900/1/1", "29991231", None], ["1900-02-29", "1899-12-31", "2024-02-30", "2024-1-1x", "2024|01|01"]),
        (
            C.bad_timestamp,
            ["", "2024-02-29", "2024-02-29 23:59:59.123456Z", "2024-02-29T2359", None],
            ["2024-02-29 24:00", "2024-02-29 10:00:00.1234567", "2024-02-29 10:00+15:00", "2024-02-30 10:00"],
        ),
        (C.bad_time, ["", "23:59:59", "235959", "10:00:00.123+14:59", "10:00:00-12:00", None], ["24:00:00", "10:00", "10:00:00.1234", "10:00:00-13:00"]),
        (lambda t: C.int_overflow(t, "smallint"), ["", "32767", "-32768", "x", "32767.9", None], ["32768", "-32769", "0" * 20]),
        (lambda t: C.int_overflow(t, "integer"), ["2147483647", "-2147483648"], ["2147483648", "-2147483649"]),
        (C.int_overflow, ["9223372036854775807", "-922337203685477580"], ["9223372036854775808", "-9223372036854775808", "1" * 21]),
        (lambda t: C.decimal_overflow(t, 5, 2), ["", "999.99", "-1", "x", None], ["1000", "1.234", "1" * 20]),
        (lambda t: C.decimal_overflow(t, 3, 0), ["999"], ["1000", "1.0"]),
        (lambda t: C.decimal_overflow(t, 2, 2), ["0.12", "0"], ["1.1"]),
        (C.float_overflow, ["", "1" * 19, "x"], ["1" * 20, "x" * 20]),
        (C.missing, ["a", " "], ["", None]),
        (lambda t: C.too_long(t, 2), ["", "日本", None], ["日本語"]),
        (lambda t: C.too_short(t, 1), ["a", None], [""]),
        (lambda t: C.above(t, 10), ["", "10", "9.9", "x", "1" * 20, None], ["10.1", "11"]),
        (lambda t: C.below(t, 0), ["", "0", "x", "-" + "1" * 19, None], ["-0.1", "-5"]),
    ],
)
def test_conditions(spark, make, good, bad):
    assert values(spark, good, make) == [False] * len(good)
    assert values(spark, bad, make) == [True] * len(bad)


@pytest.mark.parametrize("kind", [TargetType("smallint"), TargetType("int8"), TargetType("numeric", 5, 2), TargetType("float8")])
def test_type_rule_is_spelling_or_overflow(spark, kind):
    texts = ["", None, "1", "-1", "1.5", "1.555", "1000", "99999", "x", "1e3", "1" * 19, "1" * 20, "0" * 20, "9" * 19, " 1", "1\n"]
    spelling = C.bad_int if kind.family in ("smallint", "bigint") else C.bad_decimal
    overflow = {
        "smallint": lambda t: C.int_overflow(t, "smallint"),
        "bigint": C.int_overflow,
        "decimal": lambda t: C.decimal_overflow(t, 5, 2),
        "float": C.float_overflow,
    }[kind.family]
    both = values(spark, texts, lambda t: spelling(t) | overflow(t))
    assert values(spark, texts, lambda t: C.bad_type(t, kind)) == both


def test_null_texts(spark):
    texts = [None, "", "nan", "NaT", "NaN", "a\\b", "\\"]
    assert values(spark, texts, lambda t: X.strip_backslash(X.normalise_null_text(t))) == ["", "", "", "", "NaN", "ab", ""]


def test_plain_number_texts(spark):
    numbers = [112946.26, 1e7, 12345678.9, 0.0001, 1e16, 1e-5, float("nan"), -1e7, 0.0, None]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n double").orderBy("i")
    found = [r[0] for r in frame.select(X.as_text(F.col("n"), T.DoubleType())).collect()]
    assert found == [
        "112946.26", "10000000.0", "12345678.9", "0.0001", "1.0E16", "1.0E-5", "nan", "-10000000.0", "0.0", None,
    ]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in flags.select(X.as_text(F.col("b"), T.BooleanType())).collect()] == ["True", "False", None]


def test_log_texts(spark):
    codes = ["Info001", "Warn1", "Error010", "Fatal008", "other"]
    assert values(spark, codes, X.level_of_code) == ["Info", "Warn", "Error", "Fatal", "Info"]
    long = values(spark, ["x" * 6000], lambda t: X.format_message(CTX, F.lit("Info"), t, F.lit("f")))[0]
    assert len(long) == 4999 and long.startswith("【Info 】 [2024/02/01 09:00:00] xxx")
    assert values(spark, ["m"], lambda t: X.format_message(CTX, F.lit("Error"), t, F.lit("f"), F.lit("K=1"))) == [
        "【Error】 [2024/02/01 09:00:00] m(f)(K=1)"
    ]
    row = spark.createDataFrame([("1", None)], "a string, b string")
    assert row.select(X.key_text(["a", "b"])).first()[0] == "A=1,B="
    utc = spark.sql("select timestamp '2024-01-31 15:30:00' as t")
    assert utc.select(X.wall_stamp(F.col("t")), X.run_id(F.col("t"))).first()[:] == ("2024/02/01 00:30:00", "20240201003000")


@pytest.mark.parametrize(
    "flags, words",
    [((1, 0, 0), "登録"), ((1, 1, 1), "登録/削除"), ((0, 1, 0), "登録/更新"), ((0, 1, 1), "登録/更新/削除"), ((0, 0, 1), "削除"), ((0, 0, 0), "処理")],
)
def test_action_text(spark, flags, words):
    made = X.action_text(*(F.lit(bool(f)) for f in flags))
    assert spark.range(1).select(made).first()[0] == words


def test_context():
    assert (CTX.process_id, CTX.run_dt, CTX.cutoff) == ("20240201090000", "20240201_090000", datetime(2024, 1, 31, 9))


def test_settings_follow_the_data():
    assert scale_conf(10**9)["spark.sql.shuffle.partitions"] == "200"
    large = scale_conf(100 * 10**12)
    assert (large["spark.sql.shuffle.partitions"], large["spark.sql.files.maxPartitionBytes"]) == ("372530", "953m")


def test_limits_compare_all_digits(spark):
    rows = [("9007199254740993",), ("9007199254740992",), ("10.01",), ("9.99",), ("10",), ("x",), ("",)]
    df = spark.createDataFrame(rows, "t string")
    t = F.col("t")
    assert [r["t"] for r in df.where(C.above(t, 9007199254740992)).collect()] == ["9007199254740993"]
    assert [r["t"] for r in df.where(C.below(t, 10)).collect()] == ["9.99"]
    assert {r["t"] for r in df.where(C.above(t, "10")).collect()} >= {"10.01"}


DAY = r"(%s)(?:[/-]?([0-9]{2})[/-]?([0-9]{2})|[/-]([0-9]{1,2})[/-]([0-9]{1,2}))"
MOMENT = r"(?:[ T]([0-9]{2}):?([0-9]{2})(?::?([0-9]{2})(?:\.([0-9]{1,6}))?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?"


def read_day(text, year, rest=""):
    found = re.fullmatch(DAY % year + rest, text)
    if not found:
        return None
    y, *parts = found.groups()
    month, day = [p for p in parts[:4] if p is not None]
    try:
        return date(int(y), int(month), int(day)), parts[4:]
    except ValueError:
        return None


def read_moment(text, year="[0-9]{4}"):
    found = read_day(text, year, MOMENT)
    if found is None:
        return None
    day, (hour, minute, second, fraction, zone) = found
    if int(hour or 0) > 23 or int(minute or 0) > 59 or int(second or 0) > 59:
        return None
    if zone and zone != "Z" and (int(zone[1:3]) > (14 if zone[0] == "+" else 12) or int(zone[-2:]) > 59):
        return None
    micros = int((fraction or "0").ljust(6, "0"))
    return datetime(day.year, day.month, day.day, int(hour or 0), int(minute or 0), int(second or 0), micros)


def test_date_texts_against_python(spark):
    rng = random.Random(1)
    seeds = [
        "2024-02-29", "1999/12/31", "20230228", "2100-02-29", "2024-1-5", "1899-01-01", "2024-06-31", "2024-01-01 10:20:30",
        "2024/01/01T1020", "2024-01-01 102030.5Z", "2024-01-01 10:20+09:00", "2024-01-01 10:20:30.123456-12:00", "2024-13-01",
    ]
    texts = list(seeds)
    for _ in range(6000):
        text = list(rng.choice(seeds))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text))
            change = rng.choice(["swap", "drop", "add"])
            letter = rng.choice("0123456789-/: T.Z+|\n")
            text[at : at + 1] = {"swap": [letter], "drop": [], "add": [text[at], letter]}[change]
        texts.append("".join(text))
    frame = spark.createDataFrame([(t,) for t in set(texts) if t and not t.startswith("0000")], "t string")
    checked = "19[0-9]{2}|2[0-9]{3}"
    t = F.col("t")
    made = frame.select(
        t, C.bad_date(t).alias("bad_date"), C.bad_timestamp(t).alias("bad_ts"), V.to_date(t).alias("d"), V.to_timestamp(t).alias("ts")
    )
    kinds = set()
    for row in made.collect():
        text = row["t"]
        moment = read_moment(text)
        expected = (
            read_day(text, checked) is None,
            read_moment(text, checked) is None,
            moment and moment.date(),
            moment,
        )
        assert (row["bad_date"], row["bad_ts"], row["d"], row["ts"]) == expected, text
        kinds.add((expected[0], expected[1], moment is None))
    assert len(kinds) >= 4


def test_date_texts_run_one_expression_and_compile(spark):
    """However often a text's parts are used, its regular expression is in the plan once, and no code is too large."""
    texts = spark.createDataFrame([(f"2024/1/{d} 10:1{d % 10}",) for d in range(1, 29)], "t string").repartition(2)
    settings = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    uses = (V.to_date, V.to_timestamp, lambda t: V.to_timestamp(t, True), C.bad_date, C.bad_timestamp, C.bad_time)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for use in uses:
            # A filter above and two uses of the value: neither copies the expression.
            rows = texts.select(use(F.col("t")).alias("x"), "t").where("x IS NOT NULL AND length(t) > 0")
            rows = rows.select("x", F.col("x").cast("string").alias("y"))
            plan = rows._jdf.queryExecution().optimizedPlan().toString()
            assert 1 <= plan.count("regexp_replace(") <= 2, plan  # the projection's, and the filter's below it
            rows.collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
