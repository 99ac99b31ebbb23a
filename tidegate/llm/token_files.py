"""Token ids in byte-aligned variable-length code with separate control bytes, in files ordered by document.

Ids are numbered anew by falling frequency in the corpus, so that common ids take one byte. An id takes one to four
bytes; two bits of a control byte give each id's length, four ids to a byte, and control bytes stand apart from data
bytes, so that a decoder finds all lengths by one table lookup per control byte.

A file is one Parquet part with a row per document: ``doc_id``, ``start`` (ids of all documents before it),
``n_tokens``, ``control`` and ``data``. Parts follow each other in document order by ``part``. Parquet is the container
because Spark's writers reach every store; what it holds is the code above. A table of ranks lies beside the parts.

Documents are cut into parts by ranges of the id, for which only ids are dealt; the encoded documents are dealt by part
and sorted, which is the one shuffle of token data.

Cases: a null text is empty; a document has at least its end id. Null document ids come first. Documents that repeat an
id follow each other by length and content of their ids. Empty tables give empty files. Very long texts are one row.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.bpe import byte_letters
from tidegate.llm.chunks import ChunkIds, gather
from tidegate.llm.common import by_bytes, column_of, ship, text_bytes, tidy
from tidegate.session import scratch_dir, written

END_ID = 2
"""The id that ends a document."""

SLICE = 2 * 1024**2
"""Bytes of text handled at once in a task; it bounds a worker's memory."""

CHUNKS = 250_000
"""Chunks that a worker remembers."""

PART_BYTES = 64 * 1024**2
"""About this much text goes to one part."""


# Up to U+017F there are no combining characters, so nothing to compose, and lower case is per character but for the
# dotted I. The no-break space and the next-line control are white space to the library.
PLAIN = re.compile("[\x00-\x84\x86-\x9f\xa1-\u012f\u0131-\u017f]+")

# The vocabulary's splitter for such texts: contractions, letters, single numbers, anything else.
_LETTER = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")


# Classes of bytes: a Latin letter or its parts, a number, a mark, white space; 'x' are bytes of other characters.
_CLASS = bytes(
    ord("a")
    if chr(b).isascii() and chr(b).isalnum() or 0x80 <= b <= 0xBF or 0xC3 <= b <= 0xC5
    else ord(" ")
    if b == 0x20 or 0x09 <= b <= 0x0D
    else ord("x")
    if b >= 0x80
    else ord(".")
    for b in range(256)
)
# Bytes below 0xC3 that begin a character, and characters of the allowed range that are no letters.
_ODD = (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0")


def spaced(text: bytes) -> bytes:
    """The text in ASCII lower case, its stops and commas set apart where no two marks touch.

    A mark between letters, numbers or white space is a piece of its own for the splitter, so a space around it changes
    no piece; it makes more chunks equal. Where marks touch, or are no ASCII, the text stays as it is.
    """
    text = text.lower()
    kinds = text.translate(_CLASS)
    if b".." in kinds or b"x" in kinds or any(o in text for o in _ODD):
        return text
    return text.replace(b".", b" . ").replace(b",", b" , ")


MARK = "\0"
"""Stands for a word's end in texts of many words; chunks that hold it go to the library."""

LONG_WORD = 200
"""Longer words go to the library's model, whose time does not grow with the square of their length."""


def merges_of(path: str) -> list[tuple[str, str]]:
    with open(path, encoding="utf-8") as f:
        pairs = json.load(f)["model"]["merges"]
    return [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in pairs]


@functools.cache
def merges_in_turn(path: str) -> bool:
    """Whether merging a token's own text gives that token, and each token has one merge.

    Then the two parts of a token that stand side by side at last are always those of its merge, so that a merger which joins
    any two parts whose whole is a token, the earliest made first, does what the vocabulary's merges say.
    """
    pairs = merges_of(path)
    rank = {p: n for n, p in enumerate(pairs)}
    if len({a + b for a, b in pairs}) != len(pairs):
        return False
    for a, b in pairs:
        end = (a + b).endswith(WORD_END)
        text = (a + b).removesuffix(WORD_END)
        parts = [*text[:-1], text[-1] + WORD_END if end else text[-1]]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(pairs)))
            if (parts[best], parts[best + 1]) not in rank:
                return False
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return True


WORD_END = "</w>"


class Words:
    """Ids of many words by one call of a byte-pair merger. A word's last byte and the mark behind it are joined first, which
    is the vocabulary's form of a last letter."""

    def __init__(self, path: str, vocabulary: dict[str, int]):
        import tiktoken

        letters = {c: bytes([b]) for c, b in byte_letters().items()}
        mark = MARK.encode()
        singles = [bytes([b]) for b in range(256)]
        ranks = {b: n for n, b in enumerate(singles)} | {b + mark: 256 + n for n, b in enumerate(singles) if b != mark}
        name_of = {v: k for k, v in letters.items()}
        ids = [vocabulary.get(name_of[b], -1) for b in singles] + [vocabulary.get(name_of[b] + WORD_END, -1) for b in singles]
        for a, b in merges_of(path):
            token = a + b
            own = b"".join(letters[c] for c in token.removesuffix(WORD_END))
            ids.append(vocabulary[token])
            if mark not in own:
                ranks[own + mark if token.endswith(WORD_END) else own] = len(ids) - 1
        self.ids = np.array(ids, np.int64)
        self.ends = np.zeros(len(ids), bool)
        self.ends[[n for token, n in ranks.items() if token.endswith(mark)]] = True
        self.merger = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of each."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.array(self.merger.encode_ordinary(MARK.join(words) + MARK), np.int64)
        return self.ids[found], np.diff(np.flatnonzero(self.ends[found]) + 1, prepend=0)


class Encoder:
    """Ids by the tokenizers library, which sees each white-space-delimited chunk once while it is remembered.

    The vocabulary's splitter drops white space, so chunks between ASCII white space are independent. A text with the
    string of a special token goes to the library whole.
    """

    def __init__(self, path: str, in_turn: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.memory = ChunkIds(self._chunks, CHUNKS)
        self.model = self.library.model
        self.words = Words(path, self.library.get_vocab()) if in_turn else None
        self.letter_of = {b: c for c, b in byte_letters().items()}

    def _chunks(self, chunks: list[bytes]) -> list[list[int]]:
        """Chunks of plain Latin letters are normalised and cut here, and only their pieces are merged; the library's own
        normaliser takes most of its time. All others go to the library whole."""
        out: list[list[int] | None] = [None] * len(chunks)
        odd, words = [], []
        counts = np.zeros(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            text = chunk.decode()
            if text == "\n":
                out[i] = [0]
            elif not PLAIN.fullmatch(text) or MARK in text:
                odd.append((i, text))
            else:
                text = text.lower()
                own = [text] if text.isascii() and text.isalpha() else PIECES.findall(text)
                words += own
                counts[i] = len(own)
        ids, sizes = self._merged(words)
        stops = np.append(0, np.cumsum(sizes))[np.cumsum(counts)].tolist()
        flat, at = ids.tolist(), 0
        for i, stop in enumerate(stops):
            if stop > at:
                out[i], at = flat[at:stop], stop
        whole = self.library.encode_batch_fast([t for _, t in odd], add_special_tokens=False)
        for (i, _), e in zip(odd, whole, strict=True):
            out[i] = e.ids
        return out

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of each."""
        if self.words is not None and max(map(len, words), default=0) <= LONG_WORD:
            return self.words.encode(words)
        found = [[t.id for t in self.model.tokenize(self._letters(w))] for w in words]
        return np.array([x for own in found for x in own], np.int64), np.array([len(own) for own in found], np.int64)

    def _letters(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.letter_of)

    def encode(self, texts: list[bytes | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id, and their number in each text."""
        plain = [t or b"" for t in texts]
        rare = [any(s in t for s in self.specials) for t in plain]
        # A line feed is no chunk; it stands for a text's end.
        parts = [[b"\n"] if odd else [*spaced(t).split(), b"\n"] for t, odd in zip(plain, rare, strict=True)]
        places = self.memory.places([c for own in parts for c in own])
        counts = np.array([len(own) for own in parts], np.int64)
        stops = np.cumsum(counts) - 1
        sizes = self.memory.sizes[places]
        sizes[stops] = 1
        numbers = np.add.reduceat(sizes, stops - counts + 1) if len(parts) else counts
        flat = gather(self.memory.flat, self.memory.starts[places], sizes)
        flat[np.cumsum(numbers) - 1] = end
        if not any(rare):
            return flat, numbers
        split = np.split(flat, np.cumsum(numbers)[:-1])
        for i in [i for i, odd in enumerate(rare) if odd]:
            ids = self.library.encode(plain[i].decode(), add_special_tokens=False).ids
            split[i] = np.array([*ids, end], np.uint32)
        return np.concatenate(split), np.array([len(x) for x in split], np.int64)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str, in_turn: bool = False) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path, in_turn)
    return _encoders[path]


def pack(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of sequences of unsigned 32-bit integers that follow each other, and both's numbers of bytes
    for each sequence."""
    values = np.asarray(ids, np.uint32)
    sizes = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    # Each sequence's codes begin with a control byte of their own.
    quads = -(-counts // 4)
    codes = np.zeros(int(quads.sum()) * 4, np.uint8)
    shift = (np.cumsum(quads) - quads) * 4 - (np.cumsum(counts) - counts)
    codes[np.arange(len(values)) + np.repeat(shift, counts)] = sizes - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    ends = np.cumsum(sizes)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    data[starts] = values & 0xFF
    for byte in (1, 2, 3):
        longer = np.flatnonzero(sizes > byte)
        if not len(longer):
            break
        data[starts[longer] + byte] = (values[longer] >> np.uint32(8 * byte)) & 0xFF
    edges = np.append(0, ends)[np.append(0, np.cumsum(counts))]
    return control, data, quads, np.diff(edges)


# Lengths of the four ids of each control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The integers of sequences of ``counts`` integers behind their control and data bytes in a row."""
    quads = -(-counts // 4)
    shift = (np.cumsum(quads) - quads) * 4 - (np.cumsum(counts) - counts)
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    sizes = sizes[np.arange(int(counts.sum())) + np.repeat(shift, counts)]
    raw = np.frombuffer(data, np.uint8)
    starts = np.cumsum(sizes) - sizes
    out = raw[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(sizes > byte)
        if not len(longer):
            break
        out[longer] |= raw[starts[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose rows are the next ``sizes`` bytes of ``data`` each."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _encode_step(path: str, end: int, cuts: np.ndarray, in_turn: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(path, in_turn)
        for whole in batches:
            for start, stop in by_bytes(column_of(whole, "text"), SLICE):
                batch = whole.slice(start, stop - start)
                ids, counts = coder.encode(text_bytes(column_of(batch, "text")), end)
                known = column_of(batch, "doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
                # Two bytes for an id where all ids of the slice allow it; a row's length tells which.
                width = 2 if ids.max(initial=0) < 1 << 16 else 4
                columns = [
                    pa.array(np.searchsorted(cuts, known), pa.int32()),
                    column_of(batch, "doc_id"),
                    pa.array(counts, pa.int64()),
                    _binary(ids.astype(f"<u{width}"), counts * width),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "n_tokens", "raw"])

    return step


def _wide(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in a row, and their numbers."""
    raws, counts = column_of(batch, "raw").to_pylist(), column_of(batch, "n_tokens").to_numpy()
    if all(len(raw) == 2 * n for raw, n in zip(raws, counts.tolist(), strict=True)):
        return np.frombuffer(b"".join(raws), "<u2").astype(np.int64), counts
    kinds = ("<u2" if len(raw) == 2 * n else "<u4" for raw, n in zip(raws, counts.tolist(), strict=True))
    return np.concatenate([np.frombuffer(raw, k).astype(np.int64) for raw, k in zip(raws, kinds, strict=True)]), counts


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start, stop in by_bytes(column_of(whole, column), SLICE):
            yield whole.slice(start, stop - start)


def _count_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in _slices(batches, "raw"):
        found = np.bincount(_wide(batch)[0], minlength=len(total))
        total = found + np.pad(total, (0, len(found) - len(total)))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def _pack_step(rank_of: np.ndarray, before: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "raw"):
            ids, counts = _wide(batch)
            control, data, quads, sizes = pack(rank_of[ids], counts)
            starts = before[column_of(batch, "part").to_numpy()] + column_of(batch, "inner").to_numpy()
            columns = [column_of(batch, "part"), column_of(batch, "doc_id"), pa.array(starts), column_of(batch, "n_tokens")]
            columns += [_binary(control, quads), _binary(data, sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start", "n_tokens", "control", "data"])

    return step


def write(documents: DataFrame, path: str, folder: str, end: int = END_ID, part_bytes: int = PART_BYTES) -> None:
    """Encode the documents with the vocabulary at ``path`` and write the files to ``folder``."""
    spark = documents.sparkSession
    ship(spark)
    staged = _staged(documents, path, end, part_bytes)
    # One row per vocabulary entry: bounded by the vocabulary, not by the corpus.
    counted = staged.mapInArrow(tidy(_count_step), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = sorted(counted.collect(), key=lambda r: (-r.n, r.id))
    ids = np.array([r.id for r in ranked], np.int64)
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
    rank_of[ids] = np.arange(len(ids))
    # Ids before each part: one row per part, a few bytes for some 64 MB of text.
    sizes = {r.part: r.n for r in staged.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    in_order = np.array([sizes.get(part, 0) for part in range(max(sizes, default=-1) + 1)], np.int64)
    packed = staged.mapInArrow(
        tidy(_pack_step(rank_of, np.cumsum(in_order) - in_order)),
        "part int, doc_id long, start long, n_tokens long, control binary, data binary",
    )
    packed.write.parquet(f"{folder}/parts")
    ranks = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "rank long, id long")
    ranks.coalesce(1).write.parquet(f"{folder}/ranks")


def _cuts(documents: DataFrame, part_bytes: int) -> np.ndarray:
    """Largest document id of each part but the last; only ids are dealt for it."""
    size = F.octet_length(F.coalesce("text", F.lit("")))
    count = -(-(documents.agg(F.sum(size)).first()[0] or 0) // part_bytes)
    if count < 2:
        return np.array([], np.int64)
    ranged = documents.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    tops = ranged.repartitionByRange(int(count), "doc_id").groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("top"))
    return np.sort(np.array([r.top for r in tops.collect()], np.int64))[:-1]


def _staged(documents: DataFrame, path: str, end: int, part_bytes: int) -> DataFrame:
    """Encoded documents dealt by part, with the ids before each document in its part."""
    cuts = _cuts(documents, part_bytes)
    coded = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tidy(_encode_step(path, end, cuts, merges_in_turn(path))), "part int, doc_id long, n_tokens long, raw binary"
    )
    order = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"), "n_tokens", "raw")
    running = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # A part's number is that of its task, so that no two parts meet in one.
    dealt = coded.repartitionById(len(cuts) + 1, F.col("part")).withColumn("inner", running - F.col("n_tokens"))
    return written(dealt, "tokens")


def _read_step(ids: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "data"):
            counts = column_of(batch, "n_tokens").to_numpy()
            control, data = (b"".join(column_of(batch, n).to_pylist()) for n in ("control", "data"))
            found = ids[unpack(control, data, counts)].astype("<u4")
            columns = [column_of(batch, n) for n in ("doc_id", "start", "n_tokens")] + [_binary(found, counts * 4)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return step


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit integers) from the files of ``folder``."""
    ship(spark)
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    ids = np.array([r.id for r in ranks], np.int64)
    parts = spark.read.schema(
        "part int, doc_id long, start long, n_tokens long, control binary, data binary"
    ).parquet(f"{folder}/parts")
    return parts.mapInArrow(tidy(_read_step(ids)), "doc_id long, start long, n_tokens long, ids binary")


def written_and_read(documents: DataFrame, path: str, end: int = END_ID) -> DataFrame:
    """Per document, from the files: ids before it, its own ids' number and their checksum."""
    spark = documents.sparkSession
    folder = f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write(documents, path, folder, end)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
