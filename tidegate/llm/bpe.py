"""Byte-level BPE by speculation and verification.

A greedy longest match over the vocabulary proposes the tokens of each pre-token. A sequence is the one that merging
yields exactly if every adjacent pair is compatible, that is, if merging the pair's bytes alone gives the same two
tokens. Proposals and pair checks are array operations over all new pre-tokens of a batch; only pre-tokens with an
incompatible pair are merged exactly. Tokens that merging cannot produce are never proposed.

Pre-tokens of one space-delimited chunk depend on that chunk alone when it neither starts nor ends with white space,
so chunks are remembered; other texts are split whole.

Cases: a null text encodes like an empty one, to no ids. The special token's string inside a text is the special token,
as in the tokenizers library. Very long texts are handled alone. Other columns pass through ``encode`` and ``decode``;
columns named ``ids``, ``n_tokens`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.chunks import ChunkIds, gather
from tidegate.llm.common import any_names, by_bytes, column_of, quoted, ship, text_bytes, tidy

# Fixed value: the pattern by which this family of tokenizers splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = np.iinfo(np.int64).max

SLICE = 2 * 1024**2
"""Bytes of text, or of ids, handled at once in a task; it bounds a worker's memory."""


def read_spec(path: str) -> tuple[dict, dict[str, int], dict[bytes, int], list[bytes]]:
    """A vocabulary file: its content, tokens to ids, special tokens to ids, and the bytes of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    vocabulary = spec["model"]["vocab"]
    special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    bytes_of = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, i in vocabulary.items():
        bytes_of[i] = bytes(letters[c] for c in token)
    for token, i in special.items():
        bytes_of[i] = token
    return spec, vocabulary, special, bytes_of


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Merger:
    """Vocabulary and merges of one file, with the three ways to use them: propose, verify, merge."""

    def __init__(self, path: str):
        spec, vocabulary, self.special, self.bytes_of = read_spec(path)
        self.byte_ids = [vocabulary[c] for c, _ in sorted(byte_letters().items(), key=lambda x: x[1])]
        self.size = size = len(self.bytes_of)
        # Each token's rank is that of the merge that makes it; single bytes are there from the start.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        keys, ranks, made = [], [], []
        for n, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if self.left[z] < 0:
                self.rank[z], self.left[z], self.right[z] = n, x, y
            keys.append(x * size + y)
            ranks.append(n)
            made.append(z)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_keys = np.append(np.array(keys, np.int64)[order], NEVER)
        self.pair_ranks = np.append(np.array(ranks, np.int64)[order], NEVER)
        self.pair_tokens = np.append(np.array(made, np.int64)[order], -1)
        self._find_reachable()
        self._plant()

    def _find_reachable(self) -> None:
        made = np.flatnonzero(self.left >= 0)
        good = np.zeros(self.size, bool)
        good[self.byte_ids] = True
        whole = np.zeros(self.size, bool)
        whole[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:
            good[t] = whole[t] and good[self.left[t]] and good[self.right[t]]
        self.reachable = good

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge joins the last part of ``a`` and the first part of ``b`` while both are still apart.

        Goes backwards in merge order: of the two parts at the seam, the one made last is taken apart. A merge across
        the seam would have come first if it ranks below the merge that made the part just taken apart; among equal
        ranks the left one comes first.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(a), NEVER) if limit is None else limit.astype(np.int64).copy()
        fine = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            bad = self._ranks(x, y)[0] < limit[live]
            fine[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & (np.maximum(rx, ry) >= 0)
            first = go & (rx > ry)
            second = go & ~first
            i, j = live[first], live[second]
            limit[i], a[i] = rx[first], self.right[x[first]]
            limit[j], b[j] = ry[second] + 1, self.left[y[second]]
            live = live[go]
        return fine

    def _plant(self) -> None:
        """A trie of the reachable tokens: sorted (node, byte) keys, their children, the token that ends at a node."""
        children: dict[int, int] = {}
        token = [-1]
        for i in np.flatnonzero(self.reachable):
            node = 0
            for byte in self.bytes_of[i]:
                key = node * 256 + byte
                if key not in children:
                    children[key] = len(token)
                    token.append(-1)
                node = children[key]
            token[node] = int(i)
        keys = np.array(list(children), np.int64)
        order = np.argsort(keys)
        self.trie_keys = np.append(keys[order], NEVER)
        self.trie_nodes = np.append(np.array(list(children.values()), np.int64)[order], 0)
        self.trie_tokens = np.array(token, np.int64)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words ``data[s:e]`` together: word numbers and tokens, in order."""
        cursor, words, tokens = starts.copy(), [], []
        live = np.flatnonzero(cursor < ends)
        while len(live):
            best = np.full(len(live), -1, np.int64)
            node, at, go = np.zeros(len(live), np.int64), cursor[live].copy(), np.arange(len(live))
            while len(go):
                go = go[at[go] < ends[live[go]]]
                key = node[go] * 256 + data[at[go]]
                slot = np.searchsorted(self.trie_keys, key)
                go = go[hit := self.trie_keys[slot] == key]
                node[go] = self.trie_nodes[slot[hit]]
                at[go] += 1
                token = self.trie_tokens[node[go]]
                best[go[token >= 0]] = token[token >= 0]
            words.append(live)
            tokens.append(best)
            cursor[live] += self.lengths[best]
            live = live[cursor[live] < ends[live]]
        if not words:
            return np.array([], np.int64), np.array([], np.int64)
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair, NEVER without one, and its place in the table."""
        key = a * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER), at

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of all words together: each round does a word's lowest-ranked merge, from the left."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        part = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        out: list[list[int]] = [[] for _ in words]
        rank, slot = self._ranks(part, np.append(part[1:], 0))
        last = np.append(word[1:] != word[:-1], True)
        rank[last] = NEVER
        while len(part):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            counts = np.diff(np.append(first, len(part)))
            if (done := lowest == NEVER).any():
                for at, n in zip(first[done].tolist(), counts[done].tolist(), strict=True):
                    out[word[at]] = part[at : at + n].tolist()
                keep = np.repeat(~done, counts)
                part, word, rank, slot = part[keep], word[keep], rank[keep], slot[keep]
                lowest, counts = lowest[~done], counts[~done]
                if not len(part):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, counts))
            # Of pairs that overlap, as in a run of one letter, every other one from the left.
            run = np.flatnonzero(np.concatenate([[True], np.diff(hit) != 1]))
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            part[hit] = self.pair_tokens[slot[hit]]
            gone = np.zeros(len(part), bool)
            gone[hit + 1] = True
            moved = np.cumsum(~gone) - 1
            part, word = part[~gone], word[~gone]
            rank[hit] = rank[hit + 1]
            rank, slot = rank[~gone], slot[~gone]
            fresh = np.unique(np.concatenate([moved[hit], moved[hit] - 1]))
            fresh = fresh[(fresh >= 0) & (fresh < len(part) - 1)]
            inside = word[fresh] == word[fresh + 1]
            new, at = self._ranks(part[fresh], part[fresh + 1])
            rank[fresh], slot[fresh] = np.where(inside, new, NEVER), at
        return out

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens: proposed, verified, and merged where the proposal fails."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        word, token = self.propose(data, ends - sizes, ends)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair, back = np.unique(token[inner] * self.size + token[inner + 1], return_inverse=True)
        bad = ~self.compatible(pair // self.size, pair % self.size)[back] if len(pair) else np.array([], bool)
        failed = np.unique(word[inner[bad]]).tolist() if len(pair) else []
        counts = np.bincount(word, minlength=len(words))
        cuts = np.cumsum(counts)
        flat = token.tolist()
        merged = dict(zip(failed, self.merge([words[i] for i in failed]), strict=True))
        return [
            merged[i] if i in merged else flat[stop - n : stop]
            for i, (stop, n) in enumerate(zip(cuts.tolist(), counts.tolist(), strict=True))
        ]


class Encoder:
    """Texts to ids, with the chunks of earlier texts remembered."""

    def __init__(self, path: str):
        self.merger = Merger(path)
        self.split = regex.compile(PATTERN).findall
        self.inner = ChunkIds(lambda chunks: self._chunks(chunks, " "))
        self.specials = regex.compile("|".join(regex.escape(s.decode()) for s in self.merger.special) or r"(?!)")

    def _chunks(self, chunks: list[bytes], before: str) -> list[list[int] | None]:
        texts = [c.decode() for c in chunks]
        apart = [bool(t) and not t[0].isspace() and not t[-1].isspace() for t in texts]
        pieces = [self.split(before + t) if ok else [] for t, ok in zip(texts, apart, strict=True)]
        ids = self._pieces(pieces)
        return [x if ok else None for x, ok in zip(ids, apart, strict=True)]

    def _pieces(self, pieces: list[list[str]]) -> list[list[int]]:
        names = list(dict.fromkeys(p for own in pieces for p in own))
        known = dict(zip(names, self.merger.words([n.encode() for n in names]), strict=True))
        return [[i for p in own for i in known[p]] for own in pieces]

    def whole(self, text: str) -> np.ndarray:
        """Ids of one text without regard to chunks."""
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._pieces([self.split(text[at : m.start()])])[0], [self.merger.special[m[0].encode()]]]
            at = m.end()
        out.append(self._pieces([self.split(text[at:])])[0])
        return np.array([i for part in out for i in part], np.uint32)

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text. A text's first chunk has no space before it and is split with the rest of the odd ones."""
        plain = [b"" if t is None else t for t in texts]
        rare = [any(s in t for s in self.merger.special) for t in plain]
        parts = [[] if odd else t.split(b" ") for t, odd in zip(plain, rare, strict=True)]
        chunks = [c for own in parts for c in own[1:]]
        places = self.inner.places(chunks)
        sizes = self.inner.sizes[places]
        counts = np.array([max(0, len(own) - 1) for own in parts], np.int64)
        ends = np.cumsum(counts)
        heads = self._chunks([own[0] if own else b"" for own in parts], "")
        out = []
        for text, odd, head, stop, n in zip(plain, rare, heads, ends.tolist(), counts.tolist(), strict=True):
            if odd or (head is None and text) or (n and (sizes[stop - n : stop] < 0).any()):
                out.append(self.whole(text.decode()))
            else:
                out.append(np.concatenate([np.array(head or [], np.uint32), self.inner.ids(places[stop - n : stop])]))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode_step(path: str, schema: pa.Schema):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for whole in batches:
            for start, stop in by_bytes(column_of(whole, "text"), SLICE):
                batch = whole.slice(start, stop - start)
                ids = coder.encode(text_bytes(column_of(batch, "text")))
                made = {
                    "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                }
                yield _as(batch, made, schema)

    return step


def _decode_step(path: str, schema: pa.Schema):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = read_spec(path)[3]
        flat = np.frombuffer(b"".join(bytes_of), np.uint8)
        lengths = np.array([len(b) for b in bytes_of], np.int64)
        starts = np.cumsum(lengths) - lengths
        for whole in batches:
            for start, stop in by_bytes(column_of(whole, "ids"), SLICE):
                batch = whole.slice(start, stop - start)
                texts = []
                for raw in column_of(batch, "ids").to_pylist():
                    ids = np.frombuffer(raw or b"", "<u4").astype(np.int64)
                    ids = ids[ids < len(lengths)]
                    text = gather(flat, starts[ids], lengths[ids]).tobytes()
                    texts.append(text.decode("utf-8", "replace"))
                yield _as(batch, {"decoded": pa.array(texts, pa.string())}, schema)

    return step


def _as(batch: pa.RecordBatch, made: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    columns = [made[f.name] if f.name in made else column_of(batch, f.name).cast(f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _step(df: DataFrame, kept: list[str], added: str, make) -> DataFrame:
    schema = T.StructType(
        [T.StructField(df.schema[c].name, df.schema[c].dataType) for c in kept] + list(T._parse_datatype_string(added))
    )
    return df.mapInArrow(tidy(make(to_arrow_schema(schema))), schema)


@any_names
def encode(documents: DataFrame, path: str, keep_text: bool = True) -> DataFrame:
    """Adds ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``; ``path`` is a vocabulary file."""
    ship(documents.sparkSession)
    kept = [c for c in documents.columns if c.lower() not in ("ids", "n_tokens") and (keep_text or c != "text")]
    source = documents.select(*quoted(dict.fromkeys([*kept, "text"])))
    return _step(source, kept, "ids binary, n_tokens long", lambda s: _encode_step(path, s))


@any_names
def decode(encoded: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; bytes that are not UTF-8 become the replacement character."""
    ship(encoded.sparkSession)
    kept = [c for c in encoded.columns if c.lower() != "decoded"]
    out = _step(encoded.select(*quoted(kept)), kept, "decoded string", lambda s: _decode_step(path, s))
    return out if keep_ids else out.drop("ids")


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """Ids of every document and digests of the ids and of the text they decode to.

    Encoding and decoding follow each other in one task's worker, which holds the vocabulary once.
    """
    ship(documents.sparkSession)
    source = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType
    coded = [T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    first, both = T.StructType(coded), T.StructType([*coded, T.StructField("decoded", T.StringType())])
    encoding, decoding = _encode_step(path, to_arrow_schema(first)), _decode_step(path, to_arrow_schema(both))
    out = source.mapInArrow(tidy(lambda batches: decoding(encoding(batches))), both)
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )
