import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, Not, StringEndsWith, StringStartsWith

from tests.compare import compare, connect
from tidegate.llm import warc
from tidegate.llm.oracle import ORACLE
from tidegate.llm.queries import QUERIES

BIG, OTHER = "<p>héllo</p>" * 20, "<p>other</p>" * 20
ROWS = [
    (7, "http://a.example/x", BIG),
    (3, "http://b.example/y?q=1", BIG),
    (9, "http://a.example/z", BIG),
    (4, "http://c.example/\r\nEvil: yes", "tiny"),
    (5, None, "tiny"),
    (6, "http://d.example/", None),
    (8, "http://d.example/é", ""),
    (None, "http://e.example/", BIG),
    (None, "http://f.example/", OTHER),
    (None, "http://f.example/", OTHER),
    (11, "http://g.example/", "x" * 300_000),
    (12, "http://h.example/", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5),
    (13, "http://i.example/1", "twice" * 30),
    (13, "http://i.example/1", "twice" * 30),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "a", "b", "c") for r in ROWS]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, digest string, `first` string, `a.b` string"
    )


@pytest.fixture
def archived(pages, folder):
    warc.archive(pages, f"{folder}/archive", records_per_file=3)
    return f"{folder}/archive"


def by_force(rows):
    """What the contract asks for, row by row."""
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        own = first.get(data, page)
        again = len(data) >= 100 and page != own
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", own if again else None))
    return out


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def test_report_of_odd_pages(spark, pages):
    got = [tuple(r) for r in warc.report(pages).collect()]
    assert sorted(got, key=key) == sorted(by_force(ROWS), key=key)
    assert warc.report(pages.limit(0)).collect() == []


def test_report_of_tables(spark, small):
    copies = spark.read.parquet(f"{small}/pages.parquet").selectExpr("page_id", "url", "html")
    more = copies.unionByName(copies.selectExpr("page_id + 100000 AS page_id", "url", "html").where("page_id % 3 = 0"))
    rows = [tuple(r) for r in more.collect()]
    assert sorted(map(tuple, warc.report(more).collect())) == sorted(by_force(rows), key=lambda r: r[0])
    assert compare_plain(spark, small) == []


def compare_plain(spark, small):
    problems = compare(spark, connect(small), QUERIES["op11_warc"], ORACLE["op11_warc"], small)
    return [p for p in problems if not p.startswith("plan leaves")]


def test_records_round_trip(spark, archived):
    got = warc.read_archive(spark, archived).collect()
    assert len(got) == len(ROWS)
    texts = {(r.record_id, r.record_type): r for r in got}
    assert texts["urn:page:3", "response"].payload.decode() == BIG
    again = texts["urn:page:7", "revisit"]
    assert again.refers_to == "urn:page:3" and again.payload is None and again.payload_bytes == len(BIG.encode())
    assert again.headers["warc-profile"] == warc.SAME_PAYLOAD
    assert texts["urn:page:4", "response"].target_uri == "http://c.example/%0D%0AEvil: yes"
    assert texts["urn:page:5", "response"].target_uri is None
    assert texts["urn:page:8", "response"].target_uri == "http://d.example/é"
    assert texts["urn:page:12", "response"].payload.decode() == ROWS[11][2]
    assert all(r.payload_digest == f"sha256:{r.payload_sha256}" for r in got if r.payload is not None)
    assert all(r.content_length > 0 and r.headers["content-length"] == str(r.content_length) for r in got)


def test_only_wanted_columns_and_filters_reach_the_source(spark, archived):
    rows = warc.read_archive(spark, archived, ["record_type", "target_uri", "payload_bytes"])
    chosen = rows.where("record_type = 'response' AND target_uri LIKE 'http://d%' AND payload_bytes < 5")
    plan = spark._jvm.PythonSQLUtils.explainString(chosen._jdf.queryExecution(), "formatted")
    for one in ("EqualTo(record_type,response)", "StringStartsWith(target_uri,http://d", "LessThan(payload_bytes,5)"):
        assert one in plan
    assert ") Filter" not in plan and chosen.count() == 2
    by_map = warc.read_archive(spark, archived, ["record_id", "headers"]).where("headers['warc-type'] = 'revisit'")
    assert by_map.count() == 3  # not pushed, still right


def one_file(rows):
    out = b""
    for kind, uri, data in rows:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{uri}>\r\nWARC-Target-URI: {uri}\r\n"
        out += head.encode() + b"Content-Length: %d\r\n\r\n" % len(data) + data + b"\r\n\r\n"
    return out


class Watched(io.FileIO):
    """Notes how many bytes are read."""

    def __init__(self, path):
        super().__init__(path)
        self.seen = 0

    def readinto(self, buffer):
        n = super().readinto(buffer)
        self.seen += n or 0
        return n


def reader(columns, filters=(), path=""):
    whole = T.StructType.fromDDL(warc.SCHEMA)
    made = warc.WarcReader(T.StructType([whole[c] for c in columns]), path, 1 << 20)
    assert list(made.pushFilters(list(filters))) == []
    return made


def test_unwanted_payloads_are_not_read(folder):
    rows = [("response" if i % 10 == 0 else "request", f"http://s/{i}", bytes(8_000_000 if i % 10 else 1_000)) for i in range(12)]
    path = f"{folder}/x.warc"
    with open(path, "wb") as f:
        f.write(one_file(rows))
    with Watched(path) as raw:
        found = list(reader(["record_type", "payload"], [EqualTo(("record_type",), "response")])._rows(raw, path))
        assert [len(r["payload"]) for r in found] == [1_000, 1_000]
        assert raw.seen < 20_000_000  # of 80 MB: a buffer a record
    with Watched(path) as raw:
        assert len(list(reader(["target_uri"])._rows(raw, path))) == 12 and raw.seen < 20_000_000


@pytest.mark.parametrize("packed", ["no", "whole", "members"])
def test_archives_of_others(spark, folder, packed):
    rows = [("warcinfo", "", b"software: x\r\n"), ("response", "http://o/1", b"one"), ("metadata", "http://o/2", b"")]
    path = f"{folder}/o.warc"
    data = one_file(rows)
    if packed == "whole":
        data = gzip.compress(data)
    elif packed == "members":
        data = b"".join(gzip.compress(one_file([r])) for r in rows)
    with open(path, "wb") as f:
        f.write(data)
    got = warc.read_archive(spark, path, ["record_type", "payload", "payload_bytes", "refers_to"]).collect()
    assert [(r.record_type, bytes(r.payload), r.payload_bytes) for r in got] == [(k, d, len(d)) for k, _, d in rows]


@pytest.mark.parametrize("data", [b"nonsense\r\n", one_file([("response", "u", b"123456")])[:-8], b"WARC/1.0\r\nWARC-Type: x\r\n\r\n"])
def test_broken_files_are_told(folder, data):
    path = f"{folder}/broken.warc"
    with open(path, "wb") as f:
        f.write(data)
    with open(path, "rb") as raw, pytest.raises(ValueError, match="broken.warc"):
        list(reader(["payload"])._rows(raw, path))


def test_filters_follow_sql():
    row = {"target_uri": "http://a/b", "refers_to": None, "content_length": 5}
    cases = [
        (EqualTo(("refers_to",), "x"), None),
        (Not(EqualTo(("refers_to",), "x")), None),
        (IsNull(("refers_to",)), True),
        (In(("target_uri",), ("q", None)), None),
        (In(("target_uri",), ("http://a/b",)), True),
        (StringStartsWith(("target_uri",), "http"), True),
        (StringEndsWith(("target_uri",), "c"), False),
        (GreaterThan(("content_length",), 4), True),
    ]
    assert [warc._test(f, row) for f, _ in cases] == [want for _, want in cases]


def test_small_files_share_a_partition(spark, archived):
    whole = T.StructType.fromDDL(warc.SCHEMA)
    parts = warc.WarcReader(whole, archived, 1 << 26).partitions()
    assert len(parts) == 1 and len(parts[0].paths) > 2
    assert len(warc.WarcReader(whole, archived, 1).partitions()) == len(parts[0].paths)
    assert warc.read_archive(spark, archived, ["record_type"]).groupBy("record_type").count().count() == 2
    assert warc.read_archive(spark, archived, ["record_id"], split_bytes=1).agg(F.count("*")).first()[0] == len(ROWS)
