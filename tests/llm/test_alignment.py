import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidegate.llm import alignment, bpe
from tidegate.llm.common import table
from tidegate.llm.queries import BYTE_BPE, PIECE_BPE

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    whole = Tokenizer.from_file(BYTE_BPE)
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    letters = bpe.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in whole.get_vocab().items() if set(t) <= set(letters)}

    def b_bytes(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    return whole, pieces, a_bytes, b_bytes


def tokens(text, libraries):
    """Ids of both with the byte after each, None where the text has no tokens."""
    whole, pieces, a_bytes, b_bytes = libraries
    if not text:
        return None
    out = []
    for ids, of in ((whole.encode(" " + text, add_special_tokens=False).ids, a_bytes.get), (pieces.encode(text), b_bytes)):
        parts = [of(i) for i in ids]
        if b"".join(parts) != (" " + text).encode():
            return None
        out.append(list(zip(ids, np.cumsum([len(p) for p in parts]).tolist(), [len(p) for p in parts], strict=True)))
    return out


def by_force(texts, libraries):
    found, counts = [], Counter()
    for text in texts:
        both = tokens(text, libraries)
        if both is None:
            found.append(None)
            continue
        a, b = both
        links, start = [], 0
        for i, end, size in a:
            while b[start][1] <= end - size:
                start += 1
            k = start
            while k < len(b) and b[k][1] - b[k][2] < end:
                links.append((i, b[k][0]))
                k += 1
        counts.update(links)
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, i, j = [], 0, 0
        for end in ends:
            x, y = i, j
            while i < len(a) and a[i][1] <= end:
                i += 1
            while j < len(b) and b[j][1] <= end:
                j += 1
            groups.append((a[x:i], b[y:j]))
        text = ";".join("|".join(",".join(str(t[0]) for t in side) for side in g) for g in groups)
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None
        else (*f[:3], len(f[3]), sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4])
        for f in found
    ]


def result(df):
    return sorted((str(r.doc_id), *(r[n] for n in NAMES)) for r in df.collect())


@pytest.mark.parametrize("block", [2_000_000, 500])
def test_against_the_libraries(spark, small, libraries, block):
    docs = table(spark, small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = by_force([t for _, t in rows], libraries)
    got = alignment.report(docs.repartition(3), BYTE_BPE, PIECE_BPE, block)
    assert result(got) == sorted((str(d), *w) for (d, _), w in zip(rows, want, strict=True))


ODD = [
    " leading", "trailing   ", "a  b   c", "tab\t x\n  y\n\n z ", "\n", " ", "   ", "no break space　 wide", "▁ mark", "a▁b",
    "<|endoftext|> <s> </s> <0x41> <unk>", "ﬁ ligature é é", "日本語 テキスト", "\U0001f642‍ \U0001f1e9", "x" * 3_000,
    "don't we'll", "\x00 nul", "word " * 700, "Ω≈ç√ ∫˜µ", "123 4567,89", "é" * 300 + " z", None, "",
]


def test_odd_texts(spark, libraries):
    want = by_force(ODD, libraries)
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(ODD)], "doc_id int, text string, n_a int, `a.b` string")
    got = alignment.report(df.coalesce(1), BYTE_BPE, PIECE_BPE)
    assert result(got) == sorted((str(i), *w) for i, w in enumerate(want))
    assert want[8] == want[9] == (0, 0, 0, 0, 0, 0, "") and want[0][0] > 0


def test_odd_tables(spark, odd, none, libraries):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = by_force([t for _, t in rows], libraries)
    assert result(alignment.report(odd, BYTE_BPE, PIECE_BPE)) == sorted((str(d), *w) for (d, _), w in zip(rows, want, strict=True))
    assert alignment.report(none, BYTE_BPE, PIECE_BPE).collect() == []


def test_forgetting_and_small_steps_change_nothing(monkeypatch, libraries):
    texts = [t or "" for t in ODD] * 2 + ["a common word and a rare one"] * 3
    plain = alignment.Aligner(BYTE_BPE, PIECE_BPE).documents(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 2)
    monkeypatch.setattr(alignment, "AT_ONCE", 3)
    monkeypatch.setattr(alignment, "_MOST", 5)
    other = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    whole = [other.documents([t]) for t in texts]
    assert [w[0].tolist()[0] for w in whole] == plain[0].tolist() and [w[1][0] for w in whole] == plain[1]
    # Split counts add up to the same.
    for i, w in enumerate(whole):
        sums = []
        for pairs, times in ((plain[2][i], plain[3][i]), (w[2][0], w[3][0])):
            c = Counter()
            for p, n in zip(np.frombuffer(pairs, "<u4").tolist(), np.frombuffer(times, "<u2").tolist(), strict=True):
                c[p] += n
            sums.append(c)
        assert sums[0] == sums[1]


def test_products_are_those_of_matrices():
    rng = np.random.default_rng(7)
    for _ in range(30):
        a, b = ((rng.random(s) < 0.3) * rng.integers(1, 9, s) for s in ((5, 7), (7, 4)))
        made = []
        for m in (a, b):
            start = np.concatenate([[0], np.cumsum((m > 0).sum(1))])
            made.append(alignment.Rows(start, np.nonzero(m)[1], m[m > 0], m.shape[1]))
        got = alignment.product(*made)
        dense = np.zeros((5, 4), np.int64)
        dense[np.repeat(np.arange(5), np.diff(got.start)), got.at] = got.value
        assert (dense == a @ b).all() and (alignment.product_sizes(*made) == (a > 0) @ (b > 0).sum(1)).all()
        turned = made[0].transposed()
        dense = np.zeros((7, 5), np.int64)
        dense[np.repeat(np.arange(7), np.diff(turned.start)), turned.at] = turned.value
        assert (dense == a.T).all()


def test_shared_group_links():
    # Tokens end at 1 3 6 and at 2 3 5 6: groups end at 3 and 6.
    links = alignment.align(np.array([1, 2, 3]), np.array([2, 1, 2, 1]))
    assert list(zip(links.a.tolist(), links.b.tolist(), links.shared_bytes.tolist())) == [
        (0, 0, 1), (1, 0, 1), (1, 1, 1), (2, 2, 2), (2, 3, 1),
    ]
    a, b = links.shared_group()
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (2, 3)]
    assert links.same_group.tolist() == [2, 2, 2]


def test_the_quick_merger_is_exact_for_this_vocabulary():
    """Joining any two parts whose whole is a token, the earliest made first, is what the file's merges say."""
    from tidegate.llm.token_files import merges_in_turn

    tokenizer = alignment.ByteTokens(BYTE_BPE)
    assert tokenizer.quick is not None and tokenizer.apart and merges_in_turn(BYTE_BPE)
