"""Ranked lexical search by bag deduplication.

Every item is scored against all documents. Three passes:

1. **Bags.** One scan of the texts keeps of each document its number of terms and the counts of those terms that occur
   in an item (its bag). Corpus statistics and document frequencies are sums over the bags.
2. **Classes.** Documents of the same bag and the same length measure m score alike for every item. They are grouped by a
   64-bit hash of both; equality of the bags themselves, which the grouping also compares, verifies it. A class carries its
   smallest document ids, as many as a result can hold: members beyond those are behind them in every result. The limit
   is applied before the shuffle, so that a class of very many copies sends a bounded list per task.
3. **Scores.** Tasks multiply blocks of classes with the items' weights and keep each item's best classes. Those of all
   tasks are merged, expanded to members by ascending id, and ranked.

Scores are whole numbers. A block's product runs in doubles where all sums are below 2^53, which is exact, and in 64-bit
integers elsewhere. Items are dealt into blocks of bounded vocabulary; each block is a pass of its own over the texts, so
that what tasks hold does not grow with the number of items.

Cases: null and empty texts have no terms; such documents do not count into N and are in no result. Texts of any length
are handled in pieces cut at separators. Items without terms, and items with a null id, have no rows; rows that repeat
an item's id are one item with the terms of all. Rows that repeat a document's id are documents of their own, each with a
rank; null ids come after all others of their score. Equal scores are ordered by ascending id. Empty tables
give no rows. Other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import by_bytes, column_of, ship, text_bytes, tidy
from tidegate.session import written

DEPTH = 50
BLOCK_TERMS = 50_000
"""Distinct (item, term) pairs of one block of items, about; it bounds what a task holds of the items."""

PIECE = 1 << 20
"""Bytes of a text whose terms are listed at once."""

CELLS = 4_000_000
"""Numbers in one dense block of classes or weights."""

EXACT = 1 << 53

# Separators become spaces, A-Z small letters; all other bytes, and so all letters beyond ASCII, stay.
_KEEP = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces."""
    clean = (text or b"").translate(_KEEP)
    start = 0
    while start < len(clean):
        stop = start + PIECE if start + PIECE < len(clean) else len(clean)
        if stop < len(clean):
            stop = clean.find(b" ", stop)
            stop = len(clean) if stop < 0 else stop
        yield clean[start:stop].split()
        start = stop


def _item_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, text in enumerate(text_bytes(column_of(batch, "text"))):
            own = sorted({t for words in terms_of(text) for t in words})
            if own:
                ids = column_of(batch, "item").slice(i, 1).take(pa.array([0] * len(own)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.binary())], names=["item", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term``: the distinct terms of every item."""
    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").alias("item"), "text")
    return rows.mapInArrow(tidy(_item_step), f"item {kind}, term binary").distinct()


def _bag_step(terms: list[bytes]) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(terms)}.get
        for whole in batches:
            for start, stop in by_bytes(column_of(whole, "text")):
                batch = whole.slice(start, stop - start)
                lengths = np.zeros(len(batch), np.int64)
                bags = []
                for i, text in enumerate(text_bytes(column_of(batch, "text"))):
                    found = []
                    for words in terms_of(text):
                        lengths[i] += len(words)
                        found += [x for x in map(place, words) if x is not None]
                    at, counts = np.unique(np.array(found, np.int64), return_counts=True)
                    bags.append(np.stack([at, counts], 1).astype("<u4").tobytes())
                columns = [column_of(batch, "doc_id"), pa.array(lengths), pa.array(bags, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "bag"])

    return step


def bags(documents: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, bag`` of documents with terms: ``n`` terms, of which ``bag`` counts those in ``terms``.

    A bag holds pairs of 32-bit numbers, a term's place and its count, by ascending place.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text").mapInArrow(tidy(_bag_step(terms)), f"doc_id {kind}, n long, bag binary")
    return rows.where("n > 0")


def pairs_of(bag: bytes) -> np.ndarray:
    return np.frombuffer(bag, "<u4").reshape(-1, 2)


def _frequency_step(size: int) -> Callable:
    """Places and in how many bags of the task they are."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(column_of(batch, "bag").to_pylist()), "<u4").reshape(-1, 2)
            total += np.bincount(flat[:, 0], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "df"])

    return step


def _score_step(weights: dict[str, np.ndarray], items: int, depth: int) -> Callable:
    """Each item's best classes of a task, by score, then by smallest document id.

    ``weights`` has parallel arrays ``term``, ``item`` and ``weight``, sorted by term.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, ...]] = []  # item, score, first, and the class's place in `kept`
        kept: list[list] = []
        for batch in batches:
            sizes = np.array([len(b) // 8 for b in column_of(batch, "bag").to_pylist()], np.int64)
            rows = max(1, CELLS // max(1, items, int(sizes.max(initial=1))))
            for start in range(0, len(batch), rows):
                part = batch.slice(start, rows)
                members = column_of(part, "members").to_pylist()
                found = _best_of(part, weights, items, depth, np.array([_order(m) for m in members], np.int64))
                used = np.unique(found[3])
                shift = np.zeros(len(part), np.int64)
                shift[used] = len(kept) + np.arange(len(used))
                kept += [members[i] for i in used.tolist()]
                best.append((*found[:3], shift[found[3]]))
            best, kept = _merged(best, kept, depth)
        if best:
            at, score, _, place = best[0]
            members = pa.array([kept[i] for i in place.tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(score), members], names=["place", "score", "members"])

    return step


def _order(members: list) -> int:
    return np.iinfo(np.int64).max if members[0] is None else members[0]


def _top(item: np.ndarray, score: np.ndarray, first: np.ndarray, depth: int) -> np.ndarray:
    """Places of each item's ``depth`` best."""
    order = np.lexsort((first, -score, item))
    sorted_items = item[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_items[1:] != sorted_items[:-1]])) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < depth]


def _merged(best: list, kept: list, depth: int) -> tuple[list, list]:
    if not best:
        return [], []
    item, score, first, place = (np.concatenate(x) for x in zip(*best, strict=True))
    at = _top(item, score, first, depth)
    used, renamed = np.unique(place[at], return_inverse=True)
    return [(item[at], score[at], first[at], renamed)], [kept[i] for i in used.tolist()]


def _best_of(part: pa.RecordBatch, weights: dict, items: int, depth: int, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Item, score, smallest id and row of the best classes in a block."""
    flags = [pairs_of(b) for b in column_of(part, "bag").to_pylist()]
    row = np.repeat(np.arange(len(flags)), [len(f) for f in flags])
    flat = np.concatenate(flags) if flags else np.zeros((0, 2), "<u4")
    m = column_of(part, "m").to_numpy()[row]
    tf = flat[:, 1].astype(np.int64)
    value = (1_000_000_000 * tf) // (1_000 * tf + 20 * m)
    scores = np.zeros((len(flags), items), np.int64)
    # The terms that occur here, in blocks of columns that bound the dense parts.
    present, column = np.unique(flat[:, 0], return_inverse=True)
    step = max(1, CELLS // max(len(flags), items))
    largest = float(value.max(initial=0)) * float(weights["weight"].max(initial=0)) * min(step, len(present) or 1)
    kind = np.float64 if largest < EXACT else np.int64
    order = np.argsort(column, kind="stable")
    row, column, value = row[order], column[order], value[order]
    for a in range(0, len(present), step):
        terms = present[a : a + step]
        i, j = np.searchsorted(column, [a, a + len(terms)])
        left = np.zeros((len(flags), len(terms)), kind)
        left[row[i:j], column[i:j] - a] = value[i:j]
        lo, hi = np.searchsorted(weights["term"], terms, "left"), np.searchsorted(weights["term"], terms, "right")
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum())
        right = np.zeros((len(terms), items), kind)
        right[np.repeat(np.arange(len(terms)), hi - lo), weights["item"][at]] = weights["weight"][at]
        scores += (left @ right).astype(np.int64)
    # No more than `depth` a column, all that tie with the last of them included, are ranked.
    count = min(depth, len(flags))
    limit = np.partition(scores, len(flags) - count, axis=0)[len(flags) - count]
    at, item = np.nonzero((scores > 0) & (scores >= limit))
    score = scores[at, item]
    best = _top(item, score, first[at], depth)
    return item[best], score[best], first[at[best]], at[best]


def search(documents: DataFrame, items: DataFrame, depth: int = DEPTH, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``depth`` best documents of positive score.

    ``documents`` has ``doc_id`` (a whole number) and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    ship(documents.sparkSession)
    wanted = written(item_terms(items), "item_terms")
    number = max(1, -(-wanted.count() // block_terms))
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(number)))
    out = None
    for block in range(number):
        found = _search_block(documents, dealt.where(F.col("block") == block).drop("block"), depth)
        out = found if out is None else out.unionByName(found)
    return out


def _search_block(documents: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    spark = documents.sparkSession
    # About block_terms pairs; one item of more has as many as its own text.
    pairs = wanted.orderBy("item", "term").toArrow()
    names = pairs["item"].unique()
    terms = sorted(set(pairs["term"].to_pylist()))
    place = {t: i for i, t in enumerate(terms)}
    kind = documents.schema["doc_id"].dataType.simpleString()
    item_kind = wanted.schema["item"].dataType.simpleString()

    counted = written(bags(documents, terms), "bags")
    sums = counted.agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    frequency = counted.select("bag").mapInArrow(tidy(_frequency_step(len(terms))), "place long, df long")
    df = np.zeros(len(terms), np.int64)
    for row in frequency.groupBy("place").agg(F.sum("df").alias("df")).collect():  # at most a row per term of the block
        df[row["place"]] = row["df"]

    weight = np.array([math.floor(1000 * math.log((2 * sums["N"] + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    term = np.array([place[t] for t in pairs["term"].to_pylist()], np.int64)
    item = np.array(pc.index_in(pairs["item"], value_set=names).to_pylist(), np.int64)
    order = np.argsort(term, kind="stable")
    weights = {"term": term[order], "item": item[order], "weight": weight[term[order]] if len(term) else weight}

    found = _scored(classes(counted, sums["N"], sums["L"], depth), weights, len(names), depth)
    named = spark.createDataFrame(
        pa.table({"place": pa.array(range(len(names)), pa.int64()), "item_id": names})
    ) if len(names) else spark.createDataFrame([], f"place long, item_id {item_kind}")
    # A name an item of the block: bounded like its terms.
    rows = found.join(F.broadcast(named), "place").select("item_id", "score", F.explode("members").alias("doc_id"))
    order_by = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = rows.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= depth)
    return ranked.select("item_id", "rank", F.col("doc_id").cast(kind).alias("doc_id"), "score")


def classes(counted: DataFrame, documents: int, terms: int, depth: int) -> DataFrame:
    """``bag, m, members``: documents that score alike, with their ``depth`` smallest ids in order."""
    measure = F.expr(f"100 - 50 + ((50L * n * {documents}L) div {max(1, terms)}L)").alias("m")
    rows = counted.where(F.length("bag") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "bag", measure)
    rows = rows.withColumn("hash", F.xxhash64("bag", "m"))
    # Sorted by hash first; bags are compared where hashes are equal.
    own = Window.partitionBy("hash", "m", "bag").orderBy(F.asc_nulls_last("doc_id"))
    few = rows.withColumn("place", F.row_number().over(own)).where(F.col("place") <= depth)
    gathered = few.groupBy("hash", "m", "bag").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id"))).alias("all"))
    return gathered.select("bag", "m", F.col("all.doc_id").alias("members"))


def _scored(groups: DataFrame, weights: dict, items: int, depth: int) -> DataFrame:
    """``place, score, members`` of each item's best classes."""
    rows = groups.mapInArrow(tidy(_score_step(weights, items, depth)), "place long, score long, members array<long>")
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last(F.col("members")[0]))
    return rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= depth).drop("at")
