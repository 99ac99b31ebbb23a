"""Alignment of two tokenizers over the same texts by sparse incidence matrices.

A text's tokens under either tokenizer cover the same bytes. A and B are the incidence matrices tokens x bytes, in
compressed rows built by hand. The row products of A and B transposed (Gustavson: the rows of the second that a row of the first names,
added up) hold a number wherever an A token and a B token overlap: the overlap links, with the bytes they share. Where
both tokenizers end a token a group ends; the product of the tokens x groups matrices holds the shared-group links.
Their number comes from the sizes of the row products alone, so that a long group costs no square.

Neither tokenizer joins a space to what stands before it, so tokens and groups never cross from a word into the space
that follows. Texts are therefore cut there, and a chunk's tokens, links and groups are worked out once per worker and
remembered, up to a fixed number of chunks. Both vocabularies are tested for that property when they are read; with
others, whole texts are the chunks.

Passes: (1) each document's counts, group digest and packed link pairs, written; (2) counts of id pairs over the corpus,
added up in tasks first; (3) documents meet the counts. The counts are measured; they go to the tasks in blocks of
at most ``block_pairs``, one pass each, so that what is sent stays bounded whatever the vocabularies.

Cases: null and empty texts, and texts that one of the tokenizers does not give back byte for byte, have no tokens: all
numbers are zero and the digest is empty. Texts of any length are handled; very long ones alone. Repeated rows are documents
of their own, each counts. Ties for a B id's highest count all count as best. Null ids stay null. An empty table gives no
rows. Other columns are not used. Strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import bpe
from tidegate.llm.chunks import gather
from tidegate.llm.common import by_bytes, column_of, ship, text_bytes, tidy
from tidegate.session import written

BLOCK_PAIRS = 2_000_000
"""Id pairs with their counts that are sent to the tasks at once, 17 bytes each."""

REMEMBERED = 150_000
"""Chunks a worker remembers; beyond it the memory starts anew. It saves time only."""

REMEMBERED_PAIRS = 4_000_000
"""Links that remembered chunks hold together, likewise."""

AT_ONCE = 100_000
"""New chunks aligned at once."""

LONG = 256
"""Longer chunks are not remembered, and go to the tokenizers one by one."""

SLICE = 2 * 1024**2
HELD_PAIRS = 1_000_000
"""Pairs a task adds up before it hands them on."""

_SPACE = "▁"
_CHUNK = re.compile(r" +[^ ]*")
_SEAM = re.compile(r"[^\S ] ")


# ---------------------------------------------------------------- sparse matrices


@dataclass
class Rows:
    """A matrix in compressed rows: row i has the columns ``at[start[i] : start[i + 1]]`` with the numbers ``value``."""

    start: np.ndarray
    at: np.ndarray
    value: np.ndarray
    width: int

    @classmethod
    def of_ranges(cls, sizes: np.ndarray) -> Rows:
        """Row i covers the next ``sizes[i]`` columns: tokens over the bytes of a text."""
        start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        total = int(start[-1])
        return cls(start, np.arange(total), np.ones(total, np.int64), total)

    @classmethod
    def of_places(cls, places: np.ndarray, width: int) -> Rows:
        """One number a row, in the given columns: tokens in their groups."""
        return cls(np.arange(len(places) + 1), places.astype(np.int64), np.ones(len(places), np.int64), width)

    def transposed(self) -> Rows:
        rows = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        value = self.value
        if (self.at[1:] < self.at[:-1]).any():
            order = np.argsort(self.at, kind="stable")
            rows, value = rows[order], value[order]
        start = np.concatenate([[0], np.cumsum(np.bincount(self.at, minlength=self.width))]).astype(np.int64)
        return Rows(start, rows, value, len(self.start) - 1)


def product_sizes(a: Rows, b: Rows) -> np.ndarray:
    """Products that each row of ``a`` times ``b`` adds up: the first half of Gustavson's method."""
    each = np.concatenate([[0], np.cumsum(np.diff(b.start)[a.at])])
    return each[a.start[1:]] - each[a.start[:-1]]


def product(a: Rows, b: Rows) -> Rows:
    """``a`` times ``b`` row by row: the rows of ``b`` that a row of ``a`` names, times its numbers, added up."""
    sizes = np.diff(b.start)[a.at]
    rows = np.repeat(np.repeat(np.arange(len(a.start) - 1), np.diff(a.start)), sizes)
    key = rows * max(1, b.width) + gather(b.at, b.start[a.at], sizes)
    value = np.repeat(a.value, sizes) * gather(b.value, b.start[a.at], sizes)
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    value = np.add.reduceat(value, new) if len(new) else value
    key = key[new]
    start = np.searchsorted(key, np.arange(len(a.start)) * max(1, b.width))
    return Rows(start.astype(np.int64), key % max(1, b.width), value, b.width)


@dataclass
class Links:
    """The alignment of token sequences with equal bytes; parallel arrays, one per link or token."""

    a: np.ndarray
    b: np.ndarray
    shared_bytes: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    same_group: np.ndarray
    """Per A token, the number of B tokens in its group."""

    def shared_group(self) -> tuple[np.ndarray, np.ndarray]:
        """The shared-group links as places of A and B tokens."""
        width = int(self.group_a.max(initial=-1)) + 1
        both = product(Rows.of_places(self.group_a, width), Rows.of_places(self.group_b, width).transposed())
        return np.repeat(np.arange(len(self.group_a)), np.diff(both.start)), both.at


def align(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Links:
    """Links between tokens of the given byte sizes; both cover the same bytes."""
    a, b = Rows.of_ranges(a_sizes), Rows.of_ranges(b_sizes)
    overlap = product(a, b.transposed())
    # A byte ends a group where tokens of both end; a token's group is the number of such ends before its own last byte.
    ends = np.zeros((2, a.width + 1), bool)
    ends[0, a.start[1:]] = ends[1, b.start[1:]] = True
    before = np.cumsum(ends[0] & ends[1])
    group_a, group_b = before[a.start[1:] - 1], before[b.start[1:] - 1]
    groups = int(before[-1])
    in_groups = Rows.of_places(group_b, groups).transposed()
    return Links(
        np.repeat(np.arange(len(a_sizes)), np.diff(overlap.start)),
        overlap.at,
        overlap.value,
        group_a,
        group_b,
        product_sizes(Rows.of_places(group_a, groups), in_groups),
    )


# ---------------------------------------------------------------- tokenizers


class Table:
    """Byte strings end to end, to be looked up as arrays."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(x) for x in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(texts), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[ids], self.sizes[ids])


class ByteTokens:
    """A byte-level vocabulary file. ``apart`` says that chunks may be encoded one by one."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec, vocabulary, special, self.bytes_of = bpe.read_spec(path)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.whole.no_truncation()
        self.whole.no_padding()
        self.table = Table(self.bytes_of)
        cut = spec.get("pre_tokenizer") or {}
        self.apart = not spec.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", False)
        self.apart = self.apart and not cut.get("add_prefix_space", True)
        # The quick encoder merges by smallest id: right where merges make ids in their order.
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        singles = {vocabulary[c] for c in bpe.byte_letters()}
        plain = set(vocabulary.values()) - set(special.values())
        self.quick = None
        if self.apart and made == sorted(made) and singles | set(made) == plain and not spec["model"].get("ignore_merges"):
            ranks = {self.bytes_of[i]: i for i in plain}
            self.quick = tiktoken.Encoding("bytes", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, chunks: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, which have ``sizes`` bytes, and the number of each."""
        # Chunks that end in a visible character may stand in one text: each begins with a space.
        alone = [i for i, c in enumerate(chunks) if self.quick is None or len(c) > LONG or c[-1].isspace()]
        if not alone:
            ids = np.array(self.quick.encode_ordinary("".join(chunks)), np.int64)
            cuts = np.searchsorted(np.cumsum(self.table.sizes[ids]), np.cumsum(sizes)) + 1
            return ids, np.diff(cuts, prepend=0)
        # The library's merging does not slow down with the square of a word's length.
        found = [e.ids for e in self.whole.encode_batch([chunks[i] for i in alone], add_special_tokens=False)]
        together = np.ones(len(chunks), bool)
        together[alone] = False
        counts = np.zeros(len(chunks), np.int64)
        counts[alone] = [len(x) for x in found]
        if together.any():
            rest, counts[together] = self.encode([c for c, t in zip(chunks, together, strict=True) if t], sizes[together])
        else:
            rest = np.zeros(0, np.int64)
        mine = np.repeat(together, counts)
        ids = np.zeros(len(mine), np.int64)
        ids[mine] = rest
        ids[~mine] = list(chain.from_iterable(found))
        return ids, counts


class PieceTokens:
    """A sentence-piece model that puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.table = Table(self.bytes_of)
        # No piece goes on into a space, and the model neither adds nor drops spaces of its own.
        probe = "".join(self.model.id_to_piece(i) for i in self.model.encode("a  b "))
        self.apart = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces) and probe == f"{_SPACE}a{_SPACE * 2}b{_SPACE}"
        self.space = self.model.piece_to_id(_SPACE)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks and the number of each. A chunk begins with the space that the model adds to its text."""
        # Of an empty text the model makes nothing, not even its space.
        found = [ids or [self.space] for ids in self.model.encode([c[1:] for c in chunks], num_threads=1)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


def chunks_of(text: str) -> list[str]:
    """Pieces of ``text``, which begins with a space, cut before spaces that follow a visible character."""
    out = _CHUNK.findall(text)
    if not _SEAM.search(text):
        return out
    joined: list[str] = []
    for chunk in out:
        if joined and joined[-1][-1].isspace():
            joined[-1] += chunk
        else:
            joined.append(chunk)
    return joined


def _same_bytes(table: Table, ids: np.ndarray, counts: np.ndarray, text: bytes, sizes: np.ndarray) -> np.ndarray:
    """Which chunks, end to end in ``text``, their tokens give back byte for byte."""
    ends = np.concatenate([[0], np.cumsum(table.sizes[ids])])[np.cumsum(counts)]
    out = table.joined(ids).tobytes()
    if len(out) == len(text) and out == text and (ends == np.cumsum(sizes)).all():
        return np.ones(len(counts), bool)
    good, a, b = np.zeros(len(counts), bool), 0, 0
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        good[i] = out[a:end] == text[b : b + size]
        a, b = end, b + size
    return good


@dataclass
class Store:
    """Chunks and what is known of them, in parallel arrays; the links of a chunk are a range of ``pairs``."""

    place: dict[str, int] = field(default_factory=dict)
    numbers: np.ndarray = field(default_factory=lambda: np.zeros((0, 5), np.int64))
    good: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    groups: list[bytes] = field(default_factory=list)

    def add(self, chunks: list[str], found: Store) -> None:
        first = len(self.groups)
        self.starts = np.concatenate([self.starts, found.starts + len(self.pairs)])
        for name in ("numbers", "good", "pairs"):
            setattr(self, name, np.concatenate([getattr(self, name), getattr(found, name)]))
        self.groups += found.groups
        self.place.update(zip(chunks, range(first, first + len(chunks)), strict=True))


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


class Aligner:
    """Both tokenizers with a memory of aligned chunks."""

    def __init__(self, bytes_path: str, pieces_path: str):
        self.a, self.b = ByteTokens(bytes_path), PieceTokens(pieces_path)
        self.apart = self.a.apart and self.b.apart
        self.width = len(self.b.bytes_of)
        # Ids in decimal, with a place for what follows each.
        self.decimal = Table([b"%d," % i for i in range(max(len(self.a.bytes_of), self.width))])
        self.pair_type = "<u4" if len(self.a.bytes_of) * self.width <= 1 << 32 else "<u8"
        self.kept = Store()

    def chunks(self, text: str) -> list[str]:
        return chunks_of(" " + text) if self.apart else [" " + text]

    def aligned(self, chunks: list[str]) -> Store:
        """All about some distinct chunks."""
        text = "".join(chunks).encode()
        sizes = np.fromiter((len(c) if c.isascii() else len(c.encode()) for c in chunks), np.int64, len(chunks))
        a, n_a = self.a.encode(chunks, sizes)
        b, n_b = self.b.encode(chunks)
        good = _same_bytes(self.a.table, a, n_a, text, sizes) & _same_bytes(self.b.table, b, n_b, text, sizes)
        if not good.all():
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        links = align(self.a.table.sizes[a], self.b.table.sizes[b])
        many = len(chunks)
        owner = np.repeat(np.arange(many), n_a)
        n_links = np.bincount(owner[links.a], minlength=many)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (links.group_a, links.group_b))
        numbers = [
            n_a, n_b, np.bincount(owner[last_a], minlength=many), n_links,
            np.bincount(owner, weights=links.same_group, minlength=many).astype(np.int64),
        ]
        # Decimal ids of both sides in the order of their groups, A before B, with the mark that follows each.
        order = np.argsort(np.concatenate([2 * links.group_a, 2 * links.group_b + 1]), kind="stable")
        ids = np.concatenate([a, b])[order]
        marks = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order]
        written_out = self.decimal.joined(ids)
        token_ends = np.cumsum(self.decimal.sizes[ids])
        written_out[token_ends - 1] = marks
        data = written_out.tobytes()
        cuts = np.concatenate([[0], token_ends])[np.cumsum(n_a + n_b)].tolist()
        return Store(
            numbers=np.stack(numbers, 1),
            good=good,
            starts=np.cumsum(n_links) - n_links,
            pairs=a[links.a] * self.width + b[links.b],
            groups=[data[i:j] for i, j in zip([0, *cuts], cuts, strict=False)],
        )

    def places(self, chunks: list[str]) -> np.ndarray:
        """The place of each chunk in ``kept``; valid until the next call."""
        if len(self.kept.place) > REMEMBERED or len(self.kept.pairs) > REMEMBERED_PAIRS:
            self.kept = Store()
        kept = self.kept
        at = list(map(kept.place.get, chunks))
        new = list(dict.fromkeys(c for c, p in zip(chunks, at, strict=True) if p is None))
        for start in range(0, len(new), AT_ONCE):
            kept.add(new[start : start + AT_ONCE], self.aligned(new[start : start + AT_ONCE]))
        if new:
            at = list(map(kept.place.__getitem__, chunks))
        out = np.array(at, np.int64)
        for chunk in new:
            if len(chunk) > LONG:
                del kept.place[chunk]
        return out

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], list[bytes], list[bytes]]:
        """Numbers, digest, packed pairs and their times of each text."""
        cut = [self.chunks(t) if t else [] for t in texts]
        counts = np.array([len(c) for c in cut], np.int64)
        places = self.places(list(chain.from_iterable(cut)))
        kept = self.kept
        ends = np.cumsum(counts)
        owner = np.repeat(np.arange(len(texts)), counts)
        bad = np.zeros(len(texts), bool)
        bad[owner[~kept.good[places]]] = True
        bad |= counts == 0
        numbers = np.zeros((len(texts), len(NUMBERS)), np.int64)
        for k in range(len(NUMBERS)):
            numbers[:, k] = np.bincount(owner, weights=kept.numbers[places, k], minlength=len(texts))
        numbers[bad] = 0
        sizes = kept.numbers[places, 3] * ~bad[owner]
        pairs = gather(kept.pairs, kept.starts[places], sizes)
        span = len(self.a.bytes_of) * self.width
        key, times = np.unique(np.repeat(owner, sizes) * span + pairs, return_counts=True)
        key, times = _split_large(key, times)
        cuts = np.searchsorted(key, np.arange(len(texts) + 1) * span)
        pair = (key % span).astype(self.pair_type)
        times = times.astype("<u2")
        digests, packed, repeats = [], [], []
        for i, end in enumerate(ends.tolist()):
            if bad[i]:
                digests.append("")
            else:
                text = b"".join([kept.groups[p] for p in places[end - counts[i] : end].tolist()])
                digests.append(hashlib.sha256(text[:-1]).hexdigest())
            packed.append(pair[cuts[i] : cuts[i + 1]].tobytes())
            repeats.append(times[cuts[i] : cuts[i + 1]].tobytes())
        return numbers, digests, packed, repeats


_MOST = 0xFFFF


def _split_large(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts beyond two bytes take several entries."""
    parts = -(-times // _MOST)
    if (parts <= 1).all():
        return key, times
    at = np.repeat(np.arange(len(key)), parts)
    last = np.append(at[1:] != at[:-1], True)
    return key[at], np.where(last, times[at] - (parts[at] - 1) * _MOST, _MOST)


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(bytes_path: str, pieces_path: str) -> Aligner:
    """One per worker process, which later tasks find with its memory."""
    key = (bytes_path, pieces_path)
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


# ---------------------------------------------------------------- passes


def _document_step(bytes_path: str, pieces_path: str) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(bytes_path, pieces_path)
        for whole in batches:
            for start, stop in by_bytes(column_of(whole, "text"), SLICE):
                batch = whole.slice(start, stop - start)
                # Bytes that are no text come out changed, so such a document has no tokens.
                texts = [None if t is None else t.decode("utf-8", "replace") for t in text_bytes(column_of(batch, "text"))]
                numbers, digests, packed, times = aligner.documents(texts)
                columns = [column_of(batch, "doc_id"), *(pa.array(numbers[:, k]) for k in range(len(NUMBERS)))]
                columns += [pa.array(digests), pa.array(packed, pa.binary()), pa.array(times, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *NUMBERS, "groups_sha256", "pairs", "times"])

    return step


def linked(documents: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """Per document: its numbers, ``groups_sha256``, and ``pairs`` with their ``times`` as packed numbers."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{n} long' for n in NUMBERS)}, groups_sha256 string, pairs binary, times binary"
    return documents.select("doc_id", "text").mapInArrow(tidy(_document_step(bytes_path, pieces_path)), schema)


def _unpacked(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, times and the row of each."""
    packed = column_of(batch, "pairs").to_pylist()
    pairs = np.frombuffer(b"".join(packed), kind).astype(np.int64)
    times = np.frombuffer(b"".join(column_of(batch, "times").to_pylist()), "<u2").astype(np.int64)
    sizes = np.array([len(p) for p in packed], np.int64) // np.dtype(kind).itemsize
    return pairs, times, np.repeat(np.arange(len(packed)), sizes)


def _added(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(pairs, return_inverse=True)
    # Sums below 2^53 are exact in doubles; a task's are far below.
    return key, np.bincount(at, weights=times, minlength=len(key)).astype(np.int64)


def _count_step(kind: str) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            pairs, times, _ = _unpacked(batch, kind)
            found = _added(pairs, times)
            held = _added(*(np.concatenate(x) for x in zip(held, found, strict=True)))
            if len(held[0]) > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["pair", "count"])
                held = held[0][:0], held[1][:0]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["pair", "count"])

    return step


def pair_counts(rows: DataFrame, kind: str, width: int) -> DataFrame:
    """``pair, count, best``: how many links of all documents hold an id pair, and whether no pair of its B id has more."""
    parts = rows.select("pairs", "times").mapInArrow(tidy(_count_step(kind)), "pair long, count long")
    counts = parts.groupBy("pair").agg(F.sum("count").alias("count"))
    # A B id has at most as many pairs as there are A ids.
    own = Window.partitionBy(F.col("pair") % width)
    return counts.withColumn("best", F.col("count") == F.max("count").over(own))


def _lookup_step(sent, kind: str) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = sent.value
        for batch in batches:
            pairs, times, row = _unpacked(batch, kind)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            at, row, times = at[hit], row[hit], times[hit]
            sums = []
            for value in (best[at] * times, counts[at] * times):
                total = np.zeros(len(batch), np.int64)
                np.add.at(total, row, value)
                sums.append(total)
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for name, more in zip(("n_best", "count_sum"), sums, strict=True):
                columns[name] = pa.array(column_of(batch, name).to_numpy() + more)
            yield pa.RecordBatch.from_pydict(columns)

    return step


def report(documents: DataFrame, bytes_path: str, pieces_path: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Per document the numbers of tokens, groups and links, of links that are their B id's most frequent, and the sum of
    the links' counts over the corpus."""
    spark = documents.sparkSession
    aligner = Aligner(bytes_path, pieces_path)
    kind, width = aligner.pair_type, aligner.width
    rows = written(linked(documents, bytes_path, pieces_path), "linked")
    counts = written(pair_counts(rows, kind, width), "pair_counts")
    blocks = max(1, -(-counts.count() // block_pairs))
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({"n_best": zero, "count_sum": zero})
    for block in range(blocks):
        # About block_pairs rows.
        part = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).orderBy("pair").toArrow()
        sent = spark.sparkContext.broadcast(tuple(part[c].to_numpy() for c in ("pair", "count", "best")))
        rows = rows.mapInArrow(tidy(_lookup_step(sent, kind)), rows.schema)
        if block < blocks - 1:
            rows = written(rows, "looked_up")
    return rows.drop("pairs", "times")
