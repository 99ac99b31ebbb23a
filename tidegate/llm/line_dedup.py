"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words (runs of letters, digits and non-ASCII characters, A-Z lowered). Two lines match at a
Jaccard similarity of 0.8 or more. A line is removed when an earlier line of the corpus, in the order of document id,
text key and line number, matches it; that line may itself be removed. Equal sets match, so repeated lines go too.

The join orders a line's words by rarity and finds matches by prefixes. Rarity is the number of lines that hold a word
of the same hash bucket, counted over all documents in a fixed number of buckets; any total order is exact. With
overlap a needed by two lines of n words, the first n - a + 1 words of both share one, and the first n - a + 2 share
two. Words of few lines are keys of their own, and two frequent words make one key together, so that keys stay small as
the corpus grows: lines that share two words share a rare one or a pair of frequent ones. A key that still has many lines,
as lines of one template do, is cut into blocks and each pair of blocks is a group of its own, so that no task holds or
compares the whole key; how many blocks is estimated from a sample and only decides how work is dealt. Words no other line
can have (bucket count 1) are no keys. Within a key, length, position and a bitmap of word parities discard pairs. The rest are
verified with their words, which one more scan fetches for the lines concerned. A line needs one earlier match to go: it
sends its likeliest earlier partner of each key, and all of them only where it stays although it had more, so that a
group of near copies costs pairs in proportion to its lines.

Shuffled are a few numbers per line and per key, and once the texts, to bring each its removed lines. Hot lines (copies)
are one set for the join, and each task sends a set once.

Cases: a null text stays null; empty texts and lines without words stay as they are. Documents equal in id and text are
one: each row gets the same result. Null ids come first. ``deduplicated`` keeps every row and column, with ``text``
replaced and ``n_chars``, if there, set to its length; a text whose lines all go becomes empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.chunks import gather
from tidegate.llm.common import any_names, column_of, quoted, ship, text_bytes, tidy, unused
from tidegate.llm.decontaminate import words_of
from tidegate.session import written

BUCKET_BITS = 18
"""Words are counted in 2^18 buckets, whatever their number."""

FREQUENT = 1_000
"""A word of more lines makes keys only together with another frequent word."""

BLOCK = 8_192
"""About this many lines of one key are compared in one group, or twice as many where two blocks of a key meet."""

SAMPLE = 16
"""Key sizes are estimated from one different line in so many, of all documents; they decide the number of blocks only."""

KEY_ROWS = 500_000
"""Keys of frequent words are handed on in slices of about this many, however long a line is."""

MEMBER_WORDS = 256
"""A line of more words has its keys in several lists."""

FILTER_BITS = 26
"""Size of the bit filter by which the second scan knows lines to verify; a full filter only lets more through."""

SEEN = 200_000
"""Line signatures a task remembers in order to send equal lines once; more are sent again and cost time only."""

SLICE = 2 * 1024**2
_hash = xxhash.xxh3_64_intdigest


def least_overlap(n: np.ndarray) -> np.ndarray:
    """Words that two lines must share, for ``n`` words of both counted together: J >= 0.8."""
    return -(-4 * n // 9)


# Word bytes, A-Z lowered, and line feeds; all others become spaces.
_TABLE = bytes(0x0A if b == 0x0A else (words_of(bytes([b])) or [b" "])[0][0] for b in range(256))


class Lines(NamedTuple):
    """Lines with words: row of the batch, line number, number of distinct words, digest in two halves; and their words'
    hashes, sorted within each line."""

    row: np.ndarray
    number: np.ndarray
    size: np.ndarray
    one: np.ndarray
    two: np.ndarray
    hashes: np.ndarray


Part = tuple[int, int, bytes]
"""Whole lines of one text: row of the batch, number of the first line, bytes."""


def _parts(batch: pa.RecordBatch) -> Iterator[list[Part]]:
    """The texts of a batch in lists of about ``SLICE`` bytes, cut between lines only."""
    held, total = [], 0
    for row, text in enumerate(text_bytes(column_of(batch, "text"))):
        at = number = 0
        while text and at <= len(text):
            end = text.find(b"\n", at + SLICE) if len(text) - at > SLICE else -1
            part = text[at : end if end >= 0 else len(text)]
            held.append((row, number, part))
            total += len(part)
            if total >= SLICE:
                yield held
                held, total = [], 0
            if end < 0:
                break
            number += part.count(b"\n") + 1
            at = end + 1
    if held:
        yield held


def _lines(parts: list[Part]) -> Lines | None:
    """All lines with words of the given texts, None where there are none."""
    buffer = b"\n".join(part for _, _, part in parts).translate(_TABLE)
    flat = np.frombuffer(buffer, np.uint8)
    if not len(flat):
        return None
    feed = flat == 0x0A
    inside = flat != 0x20
    inside &= ~feed
    turns = np.flatnonzero(np.append(inside[1:] != inside[:-1], inside[-1])) + 1
    start, end = (np.insert(turns, 0, 0) if inside[0] else turns).reshape(-1, 2).T
    if not len(start):
        return None
    line = np.searchsorted(np.flatnonzero(feed), start)
    hashes = _word_hashes(buffer, start, end - start)
    bits = np.uint64(max(1, int(line[-1]).bit_length()))
    packed = (line.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits)
    order = np.argsort(packed)
    packed, ordered = packed[order], hashes[order]
    if ((packed[1:] == packed[:-1]) & (ordered[1:] != ordered[:-1])).any():  # hashes that only their last bits tell apart
        order = np.lexsort((hashes, line))
        ordered = hashes[order]
    line = line[order]
    new = np.append(True, (line[1:] != line[:-1]) | (ordered[1:] != ordered[:-1]))
    line, hashes = line[new], ordered[new]
    starts = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    size = np.diff(np.append(starts, len(line)))
    one, two = (np.add.reduceat(_mixed(hashes + salt), starts).view(np.int64) for salt in _SALTS)
    line = line[starts]
    ends = np.cumsum([part.count(b"\n") + 1 for _, _, part in parts])
    part = np.searchsorted(ends, line, "right")
    base = np.array([number for _, number, _ in parts]) - np.append(0, ends[:-1])
    return Lines(np.array([row for row, _, _ in parts])[part], base[part] + line, size, one, two, hashes)


def _word_hashes(buffer: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: a bijection of the bytes of words of up to 8, two such mixed for words of up to 16."""
    eights = np.ndarray(len(buffer) + 1, "<u8", buffer + bytes(8), strides=(1,))
    hashes = _mixed(eights[start] & _LOW[np.minimum(size, 8)])
    more = np.flatnonzero((size > 8) & (size <= 16))
    hashes[more] = _mixed(hashes[more] + _mixed((eights[start[more] + 8] & _LOW[size[more] - 8]) ^ _SALTS[0]))
    long = np.flatnonzero(size > 16)
    places = zip(start[long].tolist(), (start + size)[long].tolist(), strict=True)
    hashes[long] = np.fromiter((_hash(buffer[a:b]) for a, b in places), np.uint64, len(long))
    return hashes


_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SALTS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits. A line's digest is the sum of its words' mixed hashes, in two such sums."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _survey_step(schema: pa.Schema):
    """Per line its signature and place; at the end of a task, how many lines have words of each bucket."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        seen: set[int] = set()
        kind = schema.field("doc_id").type
        for batch in batches:
            for lines in filter(None, map(_lines, _parts(batch))):
                own, at = np.unique(lines.one, return_index=True)
                own = own.tolist()
                at = at[np.fromiter((x not in seen for x in own), bool, len(own))]
                seen.update(own)
                if len(seen) > SEEN:
                    seen.clear()
                fresh = np.zeros(len(lines.size), bool)
                fresh[at] = True
                buckets = lines.hashes[np.repeat(fresh, lines.size)] >> np.uint64(64 - BUCKET_BITS)
                total += np.bincount(buckets.astype(np.int64), minlength=len(total))
                row = pa.array(lines.row)
                columns = [
                    column_of(batch, "doc_id").take(row).cast(kind),
                    column_of(batch, "text_key").take(row),
                    pa.array(lines.number),
                    pa.array(lines.one),
                    pa.array(lines.two),
                    pa.nulls(len(row), pa.int64()),
                    pa.nulls(len(row), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        used = np.flatnonzero(total)
        columns = [pa.nulls(len(used), f.type) for f in list(schema)[:5]] + [pa.array(used), pa.array(total[used])]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return step


def _keys_of(sizes, hashes, counts, order_of, frequent):
    """Join keys of lines given by their sizes and word hashes: line, key and position in the line, in slices."""
    line = np.repeat(np.arange(len(sizes)), sizes)
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    # Rarest first, then by hash; hashes come sorted within a line, so a stable sort keeps that order.
    bits = max(1, int(len(sizes)).bit_length())
    packed = (line.astype(np.uint64) << np.uint64(64 - bits)) | (order_of[bucket] << np.uint64(64 - BUCKET_BITS - bits))
    order = np.argsort(packed, kind="stable")
    hashes, count = hashes[order], counts[bucket[order]]
    place = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    prefix = sizes - -(-4 * sizes // 5) + 2
    # The rarest word that two matching lines share is within the shorter prefix of both. Where that word is frequent,
    # so is every other one they share, and a second one is within the longer prefix.
    rare = (place < (prefix - 1)[line]) & (count <= frequent) & (count > 1)
    yield line[rare], hashes[rare].view(np.int64), place[rare]
    often = np.flatnonzero((place < prefix[line]) & (count > frequent))
    lines, keys, places, made = [], [], [], 0
    gap = 1
    while len(often):
        a, b = often[:-gap], often[gap:]
        same = line[a] == line[b]
        if not same.any():
            break
        a, b = a[same], b[same]
        both = (hashes[a] * np.uint64(0x9E3779B97F4A7C15) + hashes[b]) * np.uint64(0xC2B2AE3D27D4EB4F)
        lines.append(line[a])
        keys.append((both ^ (both >> np.uint64(32))).view(np.int64))
        places.append(place[a])
        made += len(a)
        if made >= KEY_ROWS:
            yield np.concatenate(lines), np.concatenate(keys), np.concatenate(places)
            lines, keys, places, made = [], [], [], 0
        gap += 1
    if made:
        yield np.concatenate(lines), np.concatenate(keys), np.concatenate(places)


INDEX = ["key", "line", "doc", "spot", "low", "high"]
"""``spot``: line number, then 16 bits each of the line's size and the key's position in it. Larger ones are cut there,
which only lets more pairs through."""

WIDE = 64
"""Lines of so many words have bitmaps of 128 bits, shorter ones of 64."""


def _parities(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of word parities: bit h mod 64 of ``low``, or for long lines bit h mod 128 over both."""
    wide = np.repeat(sizes >= WIDE, sizes) & (hashes & np.uint64(64) != 0)
    bits = np.uint64(1) << (hashes & np.uint64(63))
    starts = np.cumsum(sizes) - sizes
    none = np.uint64(0)
    low = np.bitwise_xor.reduceat(np.where(wide, none, bits), starts)
    high = np.bitwise_xor.reduceat(np.where(wide, bits, none), starts)
    return low.view(np.int64), high.view(np.int64)


def _differing(rows: np.ndarray, a: np.ndarray, b: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """At least so many words are in one line only; a bitmap of 128 bits folds to the one of 64 bits."""
    low, high = ((rows[k][a] ^ rows[k][b]).view(np.uint64) for k in (4, 5))
    apart = np.bitwise_count(low).astype(np.int64) + np.bitwise_count(high)
    return np.where(wide, apart, np.bitwise_count(low ^ high))


def _index_step(counts: np.ndarray, frequent: int, sample: int = 1):
    """Join keys of lines, with ``sample`` of one in so many different lines."""
    order_of = np.zeros(len(counts), np.uint64)
    order_of[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)

    def drawn(parts: list[Part]) -> list[Part]:
        if sample == 1:
            return parts
        chosen = lambda x: x if _hash(x, 1) % sample == 0 else b""
        return [(row, number, b"\n".join(map(chosen, part.split(b"\n")))) for row, number, part in parts]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int]] = {}
        for batch in batches:
            docs = column_of(batch, "doc").to_numpy()
            for parts in _parts(batch):
                lines = _lines(drawn(parts))
                if lines is None:
                    continue
                doc = docs[lines.row]
                order = np.lexsort((lines.number, doc, lines.one))
                one = lines.one[order]
                order = order[np.append(True, one[1:] != one[:-1])]
                # Sent once, or again from an earlier place: the least place sent is the set's first.
                at = []
                for i, one, *place in zip(*(x.tolist() for x in (order, lines.one[order], doc[order], lines.number[order])), strict=True):
                    place = tuple(place)
                    if one not in seen or place < seen[one]:
                        seen[one] = place
                        at.append(i)
                if len(seen) > SEEN:
                    seen.clear()
                if not at:
                    continue
                at = np.sort(np.array(at))
                size = lines.size[at]
                hashes = gather(lines.hashes, (np.cumsum(lines.size) - lines.size)[at], size)
                one, doc, number = lines.one[at], doc[at], lines.number[at]
                low, high = _parities(hashes, size)
                head = (number << 32) | (np.minimum(size, 0xFFFF) << 16)
                for line, key, place in _keys_of(size, hashes, counts, order_of, frequent):
                    spot = head[line] | np.minimum(place, 0xFFFF)
                    columns = [key, one[line], doc[line], spot, low[line], high[line]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=INDEX)

    return step


def _candidates(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Within each key, pairs that length, position and bitmap allow: rows of the earlier and the later line, bits that
    differ. Rows are columns of ``rows``, sorted by key and size; lines of one document id go both ways."""
    key, line, doc, spot = rows[:4]
    size, place = (spot >> 16) & 0xFFFF, spot & 0xFFFF
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(starts, len(key)))
    stop = np.repeat(starts + counts, counts)
    live, gap = np.arange(len(key)), 1
    while True:
        live = live[live + gap < stop[live]]
        # Sizes rise within a key: once a partner is too long, so are all later ones.
        live = live[(4 * size[live + gap] <= 5 * size[live]) | (size[live + gap] == 0xFFFF)]
        if not len(live):
            return
        a, b = live, live + gap
        both = size[a] + size[b]
        need = least_overlap(both)
        room = np.minimum(size[a] - place[a], size[b] - place[b])
        near = (room >= need) | (size[b] == 0xFFFF)
        a, b, both, need = a[near], b[near], both[near], need[near]
        differ = _differing(rows, a, b, size[a] >= WIDE)
        fine = ((differ <= both - 2 * need) | (size[b] == 0xFFFF)) & (line[a] != line[b])
        a, b, differ = a[fine], b[fine], differ[fine]
        if len(a):
            less, same = doc[a] < doc[b], doc[a] == doc[b]
            yield (
                np.concatenate([np.where(less, a, b), a[same]]),
                np.concatenate([np.where(less, b, a), b[same]]),
                np.append(differ, differ[same]),
            )
        gap += 1


FEW = 4
"""A line with more earlier candidates in a key sends its likeliest one; the others count only if that fails."""


def _grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of keys that several rows have, by key and size, each line once in a key at its first place; and their
    positions in ``rows``, which are sorted by key."""
    key = rows[0]
    equal = key[1:] == key[:-1]
    at = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
    key, line, doc, spot = rows[:4, at]
    order = np.lexsort((spot, doc, line, (spot >> 16) & 0xFFFF, key))
    key, line = key[order], line[order]
    at = at[order[np.append(True, (key[1:] != key[:-1]) | (line[1:] != line[:-1]))[: len(order)]]]
    return rows[:, at], at


def _pairs_in(rows: np.ndarray, few: int) -> Iterator[pa.RecordBatch]:
    """Pairs of lines with their key; ``more`` is set where ``b`` has more candidates in it. The lines of a key that has
    such a line, as far as they are candidates, follow with a null ``b``."""
    rows, _ = _grouped(rows)
    count = np.zeros(rows.shape[1], np.int64)
    best = np.full(rows.shape[1], np.iinfo(np.int64).max)
    touched = np.zeros(rows.shape[1], bool)
    kept = []
    for early, late, differ in _candidates(rows):
        np.add.at(count, late, 1)
        np.minimum.at(best, late, (differ << 40) | early)
        touched[early] = touched[late] = True
        keep = count[late] <= few
        kept.append(np.stack([early[keep], late[keep], differ[keep]]))
    if not kept:
        return
    early, late, differ = np.concatenate(kept, axis=1)
    keep = count[late] <= few
    many = np.flatnonzero(count > few)
    early = np.append(early[keep], best[many] & ((1 << 40) - 1))
    differ = np.append(differ[keep], best[many] >> 40)
    more = np.repeat([0, 1], [keep.sum(), len(many)])
    late = np.append(late[keep], many)
    nothing = pa.nulls(len(late), pa.int64())
    columns = [rows[1][early], rows[1][late], differ.astype(np.int32), rows[0][late], more.astype(np.int32)]
    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *[nothing] * 4], names=PAIR_NAMES)
    if len(many):
        group = np.cumsum(np.append(True, rows[0][1:] != rows[0][:-1]))
        wanted = np.zeros(group[-1] + 1, bool)
        wanted[group[many]] = True
        key, line, *rest = rows[:, touched & wanted[group]]
        none, short = pa.nulls(len(key), pa.int64()), pa.nulls(len(key), pa.int32())
        columns = [pa.array(line), none, short, pa.array(key), short, *map(pa.array, rest)]
        yield pa.RecordBatch.from_arrays(columns, names=PAIR_NAMES)


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by key, cut so that no key is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = column_of(batch, "key").to_numpy()
        at = int(np.searchsorted(key, key[-1]))
        if held and (at or column_of(held[-1], "key")[-1].as_py() != key[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        elif at:
            yield pa.Table.from_batches([batch.slice(0, at)])
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _pair_step(few: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_keys(_wide(batches)):
            yield from _pairs_in(np.stack([rows.column(n).to_numpy() for n in INDEX]), few)

    return step


WIDE_ROWS = 100_000


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of some 100,000 short rows, for fewer calls."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.num_rows
        if total >= WIDE_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _settle_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open lines (``open`` is 1) that an earlier line of their key matches by its words."""
    for table in _whole_keys(batches):
        rows, at = _grouped(np.stack([table.column(n).to_numpy() for n in INDEX]))
        if not len(at):
            continue
        open_ = table.column("open").to_numpy()[at] == 1
        sets = [frozenset(w) for w in table.column("words").take(pa.array(at)).to_pylist()]
        doc, number, text = rows[2], rows[3] >> 32, table.column("text_key").to_numpy()[at]
        for early, late, _ in _candidates(rows):
            sooner = (text[early] < text[late]) | ((text[early] == text[late]) & (number[early] < number[late]))
            left = open_[late] & ((doc[early] < doc[late]) | sooner)
            for a, b in zip(early[left].tolist(), late[left].tolist(), strict=True):
                if open_[b] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                    open_[b] = False
        gone = (table.column("open").to_numpy()[at] == 1) & ~open_
        yield pa.RecordBatch.from_arrays([pa.array(rows[1][gone])], names=["late"])


PAIRS = "a long, b long, differ int, key long, more int, doc long, spot long, low long, high long"
PAIR_NAMES = ["a", "b", "differ", "key", "more", "doc", "spot", "low", "high"]


def _place_hash(key: np.ndarray, line: np.ndarray) -> np.ndarray:
    mixed = (key.astype(np.uint64) + line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(
        0xC2B2AE3D27D4EB4F
    )
    return (mixed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _words_step(bits: np.ndarray):
    """The words of lines whose place the filter holds."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = column_of(batch, "text_key").to_numpy()
            for parts in _parts(batch):
                lines = [part.split(b"\n") for _, _, part in parts]
                counts = np.array([len(x) for x in lines])
                ends = np.cumsum(counts)
                first = np.repeat(np.array([number for _, number, _ in parts]) - (ends - counts), counts)
                key = np.repeat(keys[[row for row, _, _ in parts]], counts)
                place = _place_hash(key, first + np.arange(ends[-1]))
                at = np.flatnonzero(bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1))
                part = np.searchsorted(ends, at, "right")
                within = at - (ends - counts)[part]
                wanted = [lines[p][i] for p, i in zip(part.tolist(), within.tolist(), strict=True)]
                found = _lines([(row, 0, line) for row, line in enumerate(wanted)])
                if found is not None:
                    words = [sorted(set(wanted[row].translate(_TABLE).split())) for row in found.row.tolist()]
                    columns = [pa.array(found.one), pa.array(words, pa.list_(pa.binary())).cast(pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["line", "words"])

    return step


def _filter_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = _place_hash(column_of(batch, "text_key").to_numpy(), column_of(batch, "number").to_numpy())
        bit = np.uint64(1) << (place & 63).astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place >> 6), pa.array(bit.view(np.int64))], names=["word", "bit"]
        )


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("text_key"))


def removed_lines(documents: DataFrame, frequent: int = FREQUENT, few: int = FEW) -> DataFrame:
    """``doc_id, text_key, number``: the lines that an earlier line matches."""
    ship(documents.sparkSession)
    keyed = _keyed(documents)
    kind = documents.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind)]
        + [T.StructField(n, T.LongType()) for n in ("text_key", "number", "line", "check", "bucket", "n")]
    )
    survey = written(keyed.mapInArrow(tidy(_survey_step(to_arrow_schema(schema))), schema), "lines")
    # One row per bucket, of which there is a fixed number.
    counted = survey.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()

    lines = survey.where("bucket is null").select("doc_id", "text_key", "number", "line", "check")
    place = F.struct("doc_id", "text_key", "number")
    first = lines.groupBy("line", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    first = written(first, "first")

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc")
    indexed = lambda sample: keyed.select("text", doc).mapInArrow(
        tidy(_index_step(counts, frequent, sample)), "key long, line long, doc long, spot long, low long, high long"
    )
    dealt = _in_blocks(indexed(1), indexed(SAMPLE)).repartition("key").sortWithinPartitions("key")
    found = written(dealt.mapInArrow(tidy(_pair_step(few)), PAIRS), "pairs")
    gone = _gone(keyed, found, first)
    later = gone.select("first.*").distinct()
    again = first.where("times > 1").select("line", "check", "first")
    repeats = lines.join(again, ["line", "check"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_key", "number")
    return repeats.unionByName(later).distinct()


def _in_blocks(index: DataFrame, sample: DataFrame) -> DataFrame:
    """The index with each key of many lines replaced by keys of its own for each pair of blocks of these lines.

    Two lines of the key meet wherever their blocks do. Key sizes are estimated from a sample of the lines of all documents.
    """
    hot = (
        sample.groupBy(F.col("key").alias("hot"))
        .agg(F.ceil(F.count(F.lit(1)) * SAMPLE / BLOCK).cast("long").alias("blocks"))
        .where("blocks > 1")
    )
    hot = written(hot, "hot")
    if hot.isEmpty():
        return index
    rows = index.join(hot, F.col("key") == F.col("hot"), "left")
    own = F.pmod(F.xxhash64("line", F.lit(1)), F.col("blocks"))
    dealt = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != own),
        lambda j: F.xxhash64("hot", F.least(own, j), F.greatest(own, j)),
    )
    keys = F.when(F.col("blocks").isNull(), F.array("key")).otherwise(dealt)
    return rows.select(F.explode(keys).alias("key"), *INDEX[1:])


def _gone(keyed: DataFrame, found: DataFrame, first: DataFrame) -> DataFrame:
    """``line, first`` of lines that a different, earlier line matches, among the pairs and keys found."""
    pairs = found.where("b is not null").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = pairs.agg(F.min("differ").alias("differ"))
    pairs = written(pairs, "pairs")
    ends = found.select(F.explode(F.array("a", "b")).alias("line")).where("line is not null").distinct()
    wanted = written(first.join(ends, "line").select("line", "first"), "wanted")
    places = wanted.select("first.text_key", "first.number")
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    # At most one row per 64 bits of the filter.
    set_bits = places.mapInArrow(tidy(_filter_step), "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit"))
    held = set_bits.toArrow()
    bits[held.column("word").to_numpy()] = held.column("bit").to_numpy().view(np.uint64)
    words = keyed.select("text", "text_key").mapInArrow(tidy(_words_step(bits)), "line long, words array<string>")
    known = words.join(wanted.select("line"), "line", "left_semi").groupBy("line").agg(F.min("words").alias("words"))
    known = written(known, "words")
    # The earlier line of each pair; a line goes as soon as one earlier line matches it.
    sides = [wanted.select(*[F.col(c).alias(f"{c}_{side}") for c in wanted.columns]) for side in "ab"]
    placed = pairs.join(sides[0], F.col("a") == F.col("line_a")).join(sides[1], F.col("b") == F.col("line_b"))
    both = [F.struct(F.col(f"first_{side}").alias("first"), F.col(f"line_{side}").alias("line")) for side in "ab"]
    directed = placed.select(F.least(*both).alias("x"), F.greatest(*both).alias("y"), "differ")
    directed = written(directed.select(F.col("x.line").alias("early"), F.col("y.line").alias("late"), "differ"), "directed")
    # The likeliest partner first: in a group of many copies it decides for nearly all, and the other pairs of a line
    # that goes need no words. The rest are verified one by one.
    likely = directed.groupBy("late").agg(F.min(F.struct("differ", "early")).alias("best"))
    gone = written(_matching(likely.select("late", "best.early"), known), "gone")
    rest = directed.join(gone, "late", "left_anti").select("late", "early")
    gone = written(gone.unionByName(_matching(rest, known)).distinct(), "gone")
    # Lines that stay although they had more candidates than were tried: compared with all of these in their keys.
    open_ = found.where("more = 1").select(F.col("b").alias("line"), "key").distinct()
    open_ = written(open_.join(gone, F.col("line") == F.col("late"), "left_anti"), "open")
    if not open_.isEmpty():
        members = found.where("b is null").withColumnRenamed("a", "line").select(*INDEX)
        members = members.join(open_.select("key").distinct(), "key", "left_semi")
        members = members.join(open_.withColumn("open", F.lit(1).cast("long")), ["key", "line"], "left")
        members = members.withColumn("open", F.coalesce("open", F.lit(0).cast("long")))
        # A line meets its words once for all its keys, a long line once for each slice of them.
        size = F.shiftright("spot", 16).bitwiseAND(0xFFFF)
        slices = F.pmod("key", F.floor(size / MEMBER_WORDS) + 1).alias("slice")
        keys = F.collect_list(F.struct("key", "spot", "open")).alias("keys")
        members = members.groupBy("line", "doc", "low", "high", slices).agg(keys)
        members = members.join(known.join(wanted.select("line", "first.text_key"), "line"), "line")
        members = members.withColumn("own", F.explode("keys"))
        members = members.select("own.*", "line", "doc", "low", "high", "text_key", "words")
        settled = members.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_settle_step), "late long")
        gone = gone.unionByName(settled.distinct())
    return written(gone.join(wanted, F.col("late") == F.col("line")).select("line", "first"), "gone")


def _matching(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """``late`` of the pairs whose lines match."""
    early, late = (known.select(*[F.col(c).alias(f"{c}_{side}") for c in known.columns]) for side in ("early", "late"))
    with_words = pairs.join(early, F.col("early") == F.col("line_early")).join(late, F.col("late") == F.col("line_late"))
    shared = F.size(F.array_intersect("words_early", "words_late"))
    return with_words.where(9 * shared >= 4 * (F.size("words_early") + F.size("words_late"))).select("late").distinct()


def _remove_step(schema: pa.Schema, added: list[str], gone_name: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            rows = zip(text_bytes(column_of(batch, "text")), column_of(batch, gone_name).to_pylist(), strict=True)
            for text, removed in rows:
                lines = [] if text is None else text.split(b"\n")
                out = set(removed or ())
                totals.append(len(lines))
                gone.append(len(out))
                kept = text if not out else b"\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(None if kept is None else kept.decode())
            made = {
                "text": pa.array(texts, pa.string()),
                "n_lines": pa.array(totals, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
            }
            new = {"text", *added}
            columns = [made[f.name] if f.name in new else column_of(batch, f.name).cast(f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return step


@any_names
def deduplicated(documents: DataFrame, counts: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """The documents without removed lines; with ``counts`` also ``n_lines`` and ``n_removed``, replaced where there."""
    added = ["n_lines", "n_removed"] if counts else []
    kept = [c for c in documents.columns if c.lower() not in added]
    key_name, gone_name = (unused(n, documents.columns) for n in ("dedup_key", "dedup_removed"))
    lists = removed_lines(documents, frequent).groupBy("doc_id", "text_key").agg(F.collect_list("number").alias(gone_name))
    lists = written(lists, "removed").select(F.col("text_key").alias(key_name), gone_name)
    key = F.xxhash64(F.col("doc_id").cast("string"), "text").alias(key_name)
    rows = documents.select(*quoted(kept), key).join(lists, key_name, "left").select(*quoted(kept), gone_name)
    fields = [T.StructField(documents.schema[c].name, documents.schema[c].dataType) for c in kept]
    schema = T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in added)])
    out = rows.mapInArrow(tidy(_remove_step(to_arrow_schema(schema), added, gone_name)), schema)
    if "n_chars" in kept:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out


def report(documents: DataFrame) -> DataFrame:
    """Per document: lines, lines removed, and a digest of the text that stays."""
    out = deduplicated(documents.select("doc_id", "text"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
