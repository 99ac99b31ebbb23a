"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has a bit for each bit of 64 that over half of its word shingles' hashes have set. Two
fingerprints link when they differ in at most ``radius`` bits. Each bit of a fingerprint is given a non-zero vector of
``radius + 1`` bits; each non-zero vector v makes a table whose mask keeps the bits whose vector has an odd product with
v. At most ``radius`` differing bits have vectors that leave some v orthogonal to all of them, so every linked pair
agrees on the whole mask of some table: no link is missed. With ``parts`` the bits are cut into parts, each with tables
for its share of the radius; one part has no more than its share of the differing bits. More parts mean fewer tables of
shorter masks: the way to a large radius.

Equal fingerprints become one before the tables, so that exact copies cost nothing there. Within one bucket of a table
the links are found by comparison, and only a spanning set of them is handed on. A bucket of many fingerprints is cut
into blocks and each pair of blocks is a group of its own; how many blocks only decides how work is dealt. Groups of
documents are the connected components of these links.

``one_of_each_group`` keeps one document of each component, by the same fingerprints and radius.

Cases: a null text is empty; a text without words has fingerprint zero and links like any other. One of fewer words
than a shingle has is one shingle. Null document ids never name a group, unless it has no other (then null). Repeated
documents each keep their row in ``grouped``. ``one_of_each_group`` keeps the document of the smallest id; rows that
share an id are one document and stay if one of them does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import by_bytes, column_of, connected, ship, text_bytes, tidy
from tidegate.session import written

RADIUS = 3
BLOCK = 2_048
"""About this many fingerprints of one bucket are compared in one group."""

SAMPLE = 64
"""Bucket sizes are estimated from one fingerprint in so many; they decide the number of blocks only."""

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


_SECOND = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: bytes | None, size: int, seed: int = 42) -> np.ndarray:
    """Hashes of 64 bits of a text's word shingles, in text order."""
    parts = (text or b"").translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    shingles = zip(*(parts[k:] for k in range(size)), strict=False) if len(parts) >= size else [parts]
    return np.array([digest(b" ".join(s), seed) for s in shingles], np.uint64)


def fingerprint(text: bytes | None, size: int = 3, words: int = 1, seed: int = 42) -> list[int]:
    """Fingerprints of 64 bits of a text's word shingles; words are cut at ASCII white space, A-Z lowered.

    The first is of the shingles' hashes, further ones of numbers mixed from them.
    """
    hashes = shingle_hashes(text, size, seed)
    if not len(hashes):
        return [0] * words
    out = []
    for _ in range(words):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            block = np.ascontiguousarray(hashes[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]))
        hashes = (hashes ^ (hashes >> np.uint64(31))) * _SECOND
        hashes ^= hashes >> np.uint64(29)
    return out


def _fingerprint_step(size: int, words: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, stop in by_bytes(column_of(whole, "text")):
                batch = whole.slice(start, stop - start)
                prints = [fingerprint(t, size, words) for t in text_bytes(column_of(batch, "text"))]
                table = np.array(prints, np.uint64).reshape(-1, words).view(np.int64)
                columns = [column_of(batch, "doc_id"), *(pa.array(table[:, k]) for k in range(words))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *NAMES[:words]])

    return step


NAMES = ("fp", "fp2")


def fingerprints(documents: DataFrame, size: int = 3, words: int = 1) -> DataFrame:
    """``doc_id, fp`` and, with two words, ``fp2``: fingerprints as signed 64-bit integers."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{n} long" for n in NAMES[:words])])
    return documents.select("doc_id", "text").mapInArrow(tidy(_fingerprint_step(size, words)), schema)


def masks(radius: int, parts: int = 1) -> list[int]:
    """The tables' masks: in each part of the bits, bit i has vector i mod (2^(r+1) - 1) + 1 for its share r."""
    share = radius // parts
    many = (1 << (share + 1)) - 1
    out = []
    for part in range(parts):
        bits = [i for i in range(64) if i * parts // 64 == part]
        for v in range(1, many + 1):
            out.append(sum(1 << i for n, i in enumerate(bits) if ((n % many + 1) & v).bit_count() % 2))
    return out


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)


def _near(a: np.ndarray, b: np.ndarray, radius: int, limit: int) -> np.ndarray:
    """Whether rows of fingerprints differ in at most ``radius`` bits, and in ``limit`` bits over all words."""
    differ = np.bitwise_count((a ^ b).view(np.uint64))  # of signed numbers it would count the absolute value's bits
    return (differ[..., 0] <= radius) & (differ.sum(-1, dtype=np.int64) <= limit)


def spanning(nodes: np.ndarray, prints: np.ndarray, radius: int, limit: int) -> list[tuple[int, int]]:
    """Links that connect what the links within ``prints`` connect; at most one per node."""
    out, rest = [], np.arange(len(nodes))
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            one = stack.pop()
            near = _near(prints[rest], prints[one], radius, limit)
            if near.any():
                out += [(int(nodes[one]), int(nodes[i])) for i in rest[near]]
                stack += rest[near].tolist()
                rest = rest[~near]
    return out


SMALL = 128
"""Groups up to this size are compared side by side with others, larger ones alone; the links are the same."""


def _links_of(groups: np.ndarray, nodes: np.ndarray, prints: np.ndarray, radius: int, limit: int):
    """A spanning set of the links of every group; rows are sorted by group."""
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(starts, len(groups)))
    out = []
    for a, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        out += spanning(nodes[a : a + n], prints[a : a + n], radius, limit)
    size = np.repeat(sizes, sizes)
    place = np.arange(len(groups)) - np.repeat(starts, sizes)
    live = np.flatnonzero(size <= SMALL)
    for gap in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        live = live[place[live] + gap < size[live]]
        near = live[_near(prints[live], prints[live + gap], radius, limit)]
        out += zip(nodes[near].tolist(), nodes[near + gap].tolist(), strict=True)
    return _forest(out)


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A subset of the links that connects the same nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    out = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _link_step(radius: int, limit: int, words: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "node", *NAMES[:words]]
        held = np.zeros((0, len(names)), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([column_of(batch, n).to_numpy() for n in names], 1)])
            if not len(rows):
                continue
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            held = rows[cut:]
            if cut:
                yield _pairs(_links_of(rows[:cut, 0], rows[:cut, 1], rows[:cut, 2:], radius, limit))
        if len(held):
            yield _pairs(_links_of(held[:, 0], held[:, 1], held[:, 2:], radius, limit))

    return step


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    table = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], names=["a", "b"])


def links(prints: DataFrame, radius: int, parts: int = 1, limit: int = 128, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``node`` and its ``fp``) that connect all that are linked."""
    ship(prints.sparkSession)
    words = [n for n in NAMES if n in prints.columns]
    keys = F.array(
        *[
            F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(_signed(m)))
            for n, m in enumerate(masks(radius, parts))
        ]
    )
    sample = prints.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0)
    hot = (
        sample.select(F.explode(keys).alias("key"))
        .groupBy("key")
        .agg(F.ceil(F.count(F.lit(1)) * SAMPLE / block).cast("long").alias("blocks"))
        .where("blocks > 1")
    )
    # A fingerprint of a large bucket goes to every pair of blocks that its own block is in. Buckets whose hashes
    # happen to be equal are compared together, which finds nothing that is not a link.
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != own),
        lambda j: F.xxhash64("key", F.least(own, j), F.greatest(own, j)),
    )
    buckets = F.when(F.col("blocks").isNull(), F.array("key")).otherwise(pairs)
    rows = prints.select("node", *words, F.explode(keys).alias("key")).join(hot, "key", "left")
    dealt = rows.select(F.explode(buckets).alias("bucket"), "node", *words).repartition("bucket")
    step = _link_step(radius, limit, len(words))
    return dealt.sortWithinPartitions("bucket").mapInArrow(tidy(step), "a long, b long")


def grouped(prints: DataFrame, radius: int = RADIUS, parts: int = 1, limit: int = 128) -> DataFrame:
    """The rows of ``doc_id`` and fingerprints with ``component_id``, the smallest id that their links reach."""
    words = [n for n in NAMES if n in prints.columns]
    node = F.xxhash64(*words) if len(words) > 1 else F.col("fp")
    rows = written(prints.withColumn("node", node), "fingerprints")
    distinct = written(
        rows.groupBy("node").agg(*[F.first(w).alias(w) for w in words], F.min("doc_id").alias("first")), "distinct"
    )
    return named(rows, distinct, connected(links(distinct, radius, parts, limit))).drop("node")


def named(rows: DataFrame, distinct: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` with ``component_id``: the smallest ``first`` of the distinct nodes in the node's component."""
    components = written(components.withColumnRenamed("node", "linked"), "components")
    rooted = distinct.join(components, F.col("node") == F.col("linked"), "left").select(
        "node", "first", F.coalesce("component", "node").alias("root")
    )
    rooted = written(rooted, "rooted")
    lowest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "roots")
    return rows.join(written(rooted.join(lowest, "root").select("node", "component_id"), "named"), "node")


def report(documents: DataFrame, size: int = 3, radius: int = RADIUS) -> DataFrame:
    found = grouped(fingerprints(documents, size), radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(documents: DataFrame, size: int = 3, radius: int = RADIUS) -> DataFrame:
    """The documents with one of each group: that of the smallest id."""
    found = grouped(fingerprints(documents, size), radius)
    kept = written(found.where("doc_id <=> component_id").select("doc_id").distinct(), "kept")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    # The kept ids grow with the documents: they meet them by a shuffle at every size, never whole through the driver.
    return documents.alias("d").join(kept.alias("k").hint("shuffle_merge"), same, "left_semi")
