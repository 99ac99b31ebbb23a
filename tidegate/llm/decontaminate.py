"""Benchmark decontamination with suffix arrays over the training texts.

The corpus is cut into shards of whole documents. Each task builds the word suffix array of its shard and finds every
suffix of every benchmark item in it by binary search, word by word: the interval at the window's length gives all
occurrences of the window, and the deepest interval that holds a document's suffix gives its longest verbatim match.

Two reductions lose nothing. Words that no item has end a suffix, as nothing matches across them. A suffix with fewer
words before such an end than the shortest window is left out. Suffixes are ordered to the longest item's length.

The items are taken in blocks of bounded size, by measured bytes; each is a pass of its own over the texts. Between two
passes the rows are a written table, so that the driver and the tasks hold one block at a time; nothing is shuffled.

Cases: null or wordless texts have no words and no hits. Items without words match nothing. Equal items each count.
Null item ids are left out of the id list but still mark words. Repeated documents each keep their row. Empty tables
give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import any_names, by_bytes, column_of, quoted, ship, text_bytes, tidy, unused
from tidegate.session import written

BLOCK_BYTES = 16 * 1024**2
"""Most text of items in one block."""

WINDOW = 10

# Word bytes, A-Z lowered; all others become spaces. Bytes from 0x80 belong to non-ASCII characters, which are words.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Block:
    """Items of one block as word ids, with their distinct windows and all their suffixes."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        texts, starts, self.item_of = [], [], []
        size = 0
        # By id, null last: of equal matches the first item is named.
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or "", x[1] or b"")):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if not ids:
                continue
            for at in range(max(1, len(ids) - window + 1)):
                owners = windows.setdefault(tuple(ids[at : at + window]), set())
                if item_id is not None:
                    owners.add(item_id)
            starts.append((size, len(ids)))
            texts += [*ids, -1]
            size += len(ids) + 1
            self.item_of.append(item_id)
        self.owners = [sorted(x) for x in windows.values()]
        self.window_words, self.window_sizes = _padded(list(windows))
        self.words = np.array(texts or [-1], np.int64)
        # Suffixes of items, for the longest matches; shorter ones than any window cannot be found.
        self.least = int(self.window_sizes.min()) if windows else 0
        pairs = [(i, s + k, n - k) for i, (s, n) in enumerate(starts) for k in range(n - self.least + 1)]
        self.suffixes = np.array(pairs, np.int64).reshape(-1, 3)
        # What a match of each suffix needs to hold a window of its item.
        self.wanted = np.minimum(window, np.array([n for _, n in starts], np.int64))[self.suffixes[:, 0]]
        self.depth = max((n for _, n in starts), default=0)


def _padded(rows: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], np.int64)
    out = np.full((len(rows), int(sizes.max()) if rows else 0), -1, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, sizes


def suffix_array(ids: np.ndarray, least: int, depth: int, words: int) -> np.ndarray:
    """Starts of the suffixes with ``least`` known words, ordered by their first ``depth`` words (-1 ends a suffix)."""
    n = len(ids)
    ends = np.minimum.accumulate(np.where(ids < 0, np.arange(n), n)[::-1])[::-1]
    starts = np.flatnonzero(ends - np.arange(n) >= max(least, 1))
    if not len(starts):
        return starts
    bits = max(1, int(words + 1).bit_length())
    step = max(1, 62 // bits)
    padded = np.concatenate([ids, np.full(step, -1, np.int64)])
    ends = np.append(ends, n)

    def keys(at: np.ndarray, taken: int) -> np.ndarray:
        key = np.zeros(len(at), np.int64)
        for k in range(step):
            where = at + taken + k
            key = (key << bits) | np.where(where < ends[at], padded[np.minimum(where, n)] + 1, 0)
        return key

    first = keys(starts, 0)
    order = np.argsort(first, kind="stable")
    starts, first = starts[order], first[order]
    # Groups of equal prefixes are refined in place, a few words further each time.
    group = np.cumsum(np.concatenate([[0], first[1:] != first[:-1]]))
    taken = step
    open_ = np.arange(len(starts))
    while taken < depth and len(open_):
        same = np.zeros(len(open_), bool)
        equal = group[open_[1:]] == group[open_[:-1]]
        same[1:] |= equal
        same[:-1] |= equal
        open_ = open_[same & (starts[open_] + taken < ends[starts[open_]])] if len(open_) else open_
        # A suffix that has ended sorts before the longer ones of its group and stays where it is.
        if not len(open_):
            break
        members = np.flatnonzero(np.isin(group, np.unique(group[open_])))
        key = keys(starts[members], taken)
        order = np.lexsort((key, group[members]))
        starts[members] = starts[members][order]
        key = key[order]
        old = group[members]
        new = np.cumsum(np.concatenate([[0], (old[1:] != old[:-1]) | (key[1:] != key[:-1])]))
        group[members] = new + group.max() + 1
        open_ = members
        taken += step
    return starts


def _narrow(text, array, low, high, depth, wanted):
    """Narrow each interval to the suffixes whose word at ``depth`` is the wanted one, by two binary searches."""

    def bound(after: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while True:
            go = a < b
            if not go.any():
                return a
            mid = (a + b) // 2
            value = text[np.minimum(array[np.minimum(mid, len(array) - 1)] + depth, len(text) - 1)]
            right = (value <= wanted) if after else (value < wanted)
            a = np.where(go & right, mid + 1, a)
            b = np.where(go & ~right, mid, b)

    return bound(False), bound(True)


def search(text: np.ndarray, array: np.ndarray, block: Block):
    """Occurrences of windows as ``(start, window)``, and per suffix of the text its longest match ``(length, start)``."""
    found, window = windows_in(text, array, block)
    return found, window, longest_in(text, array, block)[0], array


def windows_in(text: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Start and window of every occurrence."""
    count = len(block.window_sizes)
    low, high = np.zeros(count, np.int64), np.full(count, len(array), np.int64)
    for depth in range(block.window_words.shape[1]):
        live = np.flatnonzero((low < high) & (depth < block.window_sizes))
        if not len(live):
            break
        low[live], high[live] = _narrow(text, array, low[live], high[live], depth, block.window_words[live, depth])
    sizes = np.maximum(high - low, 0)
    window = np.repeat(np.arange(count), sizes)
    offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = array[np.repeat(low, sizes) + offset]
    return found, window


def longest_in(text: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix in ``array`` the length of its longest match that holds a window, and the item suffix it matches.

    Intervals of one depth are equal or apart, so each place is set once a depth, from the first of equal ones.
    """
    length, suffix = np.zeros(len(array), np.int64), np.full(len(array), -1, np.int64)
    total = len(block.suffixes)
    low, high = np.zeros(total, np.int64), np.full(total, len(array), np.int64)
    live, depth = np.arange(total), 0
    while len(live):
        live = live[depth < block.suffixes[live, 2]]
        a, b = _narrow(text, array, low[live], high[live], depth, block.words[block.suffixes[live, 1] + depth])
        keep = a < b
        live = live[keep]
        low[live], high[live] = a[keep], b[keep]
        depth += 1
        enough = live[depth >= block.wanted[live]]
        begin, first = np.unique(low[enough], return_index=True)
        sizes = high[enough[first]] - begin
        places = np.repeat(begin, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        length[places], suffix[places] = depth, np.repeat(enough[first], sizes)
    return length, suffix


def _matcher(block: Block, schema: pa.Schema):
    """A step over documents that adds the hits of one block to those found before."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = block.vocabulary.get
        for whole in batches:
            texts = column_of(whole, "text")
            for start, stop in by_bytes(texts):
                batch = whole.slice(start, stop - start)
                parts, sizes = [], []
                for text in text_bytes(column_of(batch, "text")):
                    words = words_of(text)
                    sizes.append(len(words))
                    parts.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
                    parts.append(np.array([-1]))
                text = np.concatenate(parts) if parts else np.array([-1])
                yield _found(batch, text, np.array(sizes, np.int64), block, schema)

    return step


def _found(batch, text, sizes, block, schema) -> pa.RecordBatch:
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    hits = column_of(batch, "hits").to_pylist()
    items = column_of(batch, "items").to_pylist()
    longest = column_of(batch, "longest").to_pylist()
    array = suffix_array(text, block.least, block.depth, len(block.vocabulary)) if block.least else np.array([], int)
    if len(array):
        found, window = windows_in(text, array, block)
        if len(found):
            mark = np.zeros(len(text) + 1, np.int64)
            np.add.at(mark, found, 1)
            np.add.at(mark, found + block.window_sizes[window], -1)
            covered = np.cumsum(mark[:-1]) > 0
            owner = np.searchsorted(begins, found, "right") - 1
            order = np.argsort(owner, kind="stable")
            docs, first = np.unique(owner[order], return_index=True)
            for doc, own in zip(docs, np.split(window[order], first[1:]), strict=True):
                a, b = begins[doc], begins[doc] + sizes[doc]
                old = np.zeros(sizes[doc], bool)
                for x, y in hits[doc] or []:
                    old[x:y] = True
                edge = np.flatnonzero(np.diff(np.concatenate([[0], (old | covered[a:b]).astype(np.int8), [0]])))
                hits[doc] = edge.reshape(-1, 2).tolist()
                items[doc] = sorted(set(items[doc] or []).union(*(block.owners[w] for w in np.unique(own))))
            # Of each document's matches the longest, then the first; of several blocks' also the least item.
            length, suffix = longest_in(text, array, block)
            good = np.flatnonzero(length)
            docs = np.searchsorted(begins, array[good], "right") - 1
            good = good[np.lexsort((array[good], -length[good], docs))]
            docs, first = np.unique(np.searchsorted(begins, array[good], "right") - 1, return_index=True)
            for doc, i in zip(docs, good[first], strict=True):
                one = {
                    "words": int(length[i]),
                    "doc_at": int(array[i] - begins[doc]),
                    "item_id": block.item_of[block.suffixes[suffix[i], 0]],
                }
                if not longest[doc] or _rank(one) < _rank(longest[doc]):
                    longest[doc] = one
    data = {f: column_of(batch, f) for f in schema.names}
    data |= {
        "n_words": pa.array(sizes, pa.int64()),
        "hits": pa.array(hits, schema.field("hits").type),
        "items": pa.array(items, schema.field("items").type),
        "longest": pa.array(longest, schema.field("longest").type),
    }
    return pa.RecordBatch.from_arrays([data[n].cast(schema.field(n).type) for n in schema.names], schema=schema)


def _rank(match: dict) -> tuple:
    return -match["words"], match["doc_at"], match["item_id"] is None, match["item_id"] or ""


def block_count(benchmark: DataFrame, block_bytes: int) -> int:
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def block_of(benchmark: DataFrame, window: int, count: int, number: int) -> Block:
    """The items of one of ``count`` blocks, dealt by hash."""
    keyed = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    part = keyed.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
    return Block([(r[0], r[1].encode() if r[1] is not None else None) for r in part.collect()], window)


ADDED = ("n_words", "hits", "items", "longest")


@any_names
def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    columns: list[str] | None = None,
) -> DataFrame:
    """Columns of the documents (all unless named) with ``n_words``, ``hits``, ``items`` and ``longest``.

    ``hits`` are word ranges, ``items`` ids as strings; ``longest`` is each document's longest match that
    holds a window, with its word offset and item; of equal ones the first in the document, then the least item id. Columns of these names in the documents are replaced.
    """
    ship(documents.sparkSession)
    columns = [c for c in columns or documents.columns if c.lower() not in ADDED]
    out = documents.select(
        *quoted(dict.fromkeys([*columns, "text"])),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<array<long>>").alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("struct<words:long,doc_at:long,item_id:string>").alias("longest"),
    )
    count = block_count(benchmark, block_bytes)
    for k in range(count):
        last = k == count - 1
        kept = out.select(*quoted([*columns, *ADDED])) if last else out
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept.schema.fields])
        step = _matcher(block_of(benchmark, window, count, k), _arrow(schema))
        out = out.mapInArrow(tidy(step), schema)
        if not last:  # so that neither the driver nor a task holds two blocks
            out = written(out, "matched")
    return out


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit, items with occurring windows and a digest of their ids."""
    found = contamination(documents, benchmark, window, columns=["doc_id"])
    hit = F.aggregate(
        F.coalesce("hits", F.array().cast("array<array<long>>")), F.lit(0).cast("long"), lambda s, h: s + h[1] - h[0]
    )
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@any_names
def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without those that hold a window of an item."""
    own = {c: unused(f"kept_{c}", documents.columns) for c in documents.columns if c.lower() in ADDED}
    shielded = documents.withColumnsRenamed(own)
    found = contamination(shielded, benchmark, window).where("hits is null")
    back = [F.col(q).alias(c) for q, c in zip(quoted(shielded.columns), documents.columns, strict=True)]
    return found.select(*back)
