import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegate.llm import bpe, token_files
from tidegate.llm.common import table
from tidegate.llm.queries import BYTE_BPE, WORD_BPE

CURIOUS = [
    "", "  a  b", "a\n b", " x", "x ", "don't I'll  we've\t\tq", "<|endoftext|>hi <|endoftext|> x", "a" * 3000,
    "日本語 １２３ ½", "é́   x", "\x00\x1c a\x85b", "🙂🙂 ok", " \n \n", "12 +-*/", "K Σίσυφος İ ß", "a.b,c ... d.,e",
    "x\xa0y z\u2003w", "naïve—test “q” …", "3.14, 2.7'S",
]


def test_byte_bpe_equals_library(small):
    library = Tokenizer.from_file(BYTE_BPE)
    coder = bpe.Encoder(BYTE_BPE)
    found = coder.encode([t.encode() for t in CURIOUS])
    for text, ids in zip(CURIOUS, found, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_merger_ways_agree():
    merger = bpe.encoder(BYTE_BPE).merger
    rng = np.random.default_rng(5)
    words = [bytes(rng.choice(list(b" theanousrqzx\xc3\xa9"), rng.integers(1, 24))) for _ in range(2000)]
    assert merger.words(words) == merger.merge(words)
    assert merger.words([]) == [] and merger.merge([]) == []


def test_round_trip(spark, odd, none):
    library = Tokenizer.from_file(BYTE_BPE)
    rows = odd.select("doc_id", "text").collect()
    got = bpe.round_trip(odd, BYTE_BPE).collect()
    want = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:4]) for r in got)
    assert bpe.round_trip(none, BYTE_BPE).count() == 0
    kept = bpe.encode(odd, BYTE_BPE)
    assert set(odd.columns) == set(kept.columns) and kept.where("lang = 'de'").first().score == "keep-3"


def test_broken_ids_decode(spark):
    broken = spark.createDataFrame([(1, b"\xa4\x00\x00\x00"), (2, None), (3, b"\xff\xff\xff\x7f")], "doc_id long, ids binary")
    texts = {r.doc_id: r.decoded for r in bpe.decode(broken, BYTE_BPE).collect()}
    assert texts[2] == "" and texts[3] == "" and len(texts[1]) == 1


def test_word_bpe_equals_library():
    coder = token_files.Encoder(WORD_BPE)
    library = Tokenizer.from_file(WORD_BPE)
    texts = CURIOUS + [f"a{chr(i)}b {chr(i)}{chr(i)} 1{chr(i)}2.x" for i in range(0x180)]
    flat, counts = coder.encode([t.encode() for t in texts], 2)
    for text, ids in zip(texts, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 3, 4, 5, 0, 1000, 7])
    values = (2 ** rng.uniform(0, 32, counts.sum())).astype(np.uint64).clip(0, 2**32 - 1).astype(np.uint32)
    control, data, quads, sizes = token_files.pack(values, counts)
    assert quads.tolist() == [0, 1, 1, 1, 2, 0, 250, 2] and sizes.sum() == len(data) and quads.sum() == len(control)
    assert (token_files.unpack(control.tobytes(), data.tobytes(), counts) == values).all()
    # A sequence's own bytes hold it.
    at, start, stop = np.cumsum(counts), np.cumsum(sizes) - sizes, np.cumsum(sizes)
    one = token_files.unpack(control[3:5].tobytes(), data[start[4] : stop[4]].tobytes(), counts[4:5])
    assert (one == values[at[3] : at[4]]).all()
    empty = token_files.pack(values[:0], counts[:0])
    assert len(empty[0]) == len(empty[1]) == 0


def in_order(rows, library):
    at, out = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("part_bytes", [2_000, 64 * 1024**2])
def test_files_hold_every_document_in_order(spark, small, folder, part_bytes):
    docs = table(spark, small, "documents")
    token_files.write(docs, WORD_BPE, folder + "/tokens", part_bytes=part_bytes)
    back = token_files.read(spark, folder + "/tokens").select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c"))
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    assert [tuple(r) for r in back.orderBy("start").collect()] == in_order(rows, Tokenizer.from_file(WORD_BPE))
    # Each part holds a range of ids, in order within its file.
    parts = spark.read.parquet(folder + "/tokens/parts").groupBy("part").agg(F.min("doc_id"), F.max("doc_id")).collect()
    tops = [tuple(r)[1:] for r in sorted(parts)]
    assert all(a[1] < b[0] for a, b in zip(tops, tops[1:]))
    assert (len(tops) > 5) == (part_bytes == 2_000)


def test_files_of_odd_documents(spark, odd, none):
    got = token_files.written_and_read(odd, WORD_BPE).orderBy("start").collect()
    rows = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [tuple(r) for r in got] == in_order(rows, Tokenizer.from_file(WORD_BPE))
    assert token_files.written_and_read(none, WORD_BPE).count() == 0


def test_many_words_at_once_are_the_librarys():
    """The merger that stands in for the library's model, over words of every kind, long ones and the mark included."""
    import time

    import numpy as np
    from tokenizers import Tokenizer

    from tidegate.llm import token_files

    start = time.perf_counter()
    assert token_files.merges_in_turn(WORD_BPE) and time.perf_counter() - start < 60
    library = Tokenizer.from_file(WORD_BPE)
    rng = np.random.default_rng(8)
    letters = np.array(list("etaoinshrdlucmfwypvbgkjqxzéèüößñç019'-_!\x01\x7f"))
    texts = ["".join(rng.choice(letters, rng.integers(1, 14))) for _ in range(30_000)]
    texts += [t.removesuffix("</w>") for t in list(library.get_vocab())[::7] if t.removesuffix("</w>").isascii()]
    texts += ["x" * 500, "a\0b", "\0", "don't", "it's-1", "ab" * 90, "<|endoftext|>x"]
    coder = token_files.Encoder(WORD_BPE, True)
    assert coder.words is not None
    chunks = [c for c in dict.fromkeys(p for t in texts for p in t.lower().encode().split()) if b"<|" not in c]
    want = [e.ids for e in library.encode_batch([c.decode() for c in chunks], add_special_tokens=False)]
    got = []
    for at in range(0, len(chunks), 999):  # a batch with a long word goes to the model, the others do not
        got += coder._chunks(chunks[at : at + 999])
    assert [list(g) for g in got] == [list(w) for w in want]
