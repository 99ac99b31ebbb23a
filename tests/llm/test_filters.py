import hashlib
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import decontaminate, licenses, pii, quality
from tidegate.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def hits_by_force(docs, items, window=10):
    owners = {}
    for item_id, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[k : k + window]), set()).update([] if item_id is None else [str(item_id)])
    sizes, out = {len(k) for k in owners}, []
    for doc_id, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := owners.get(tuple(w[k : k + n]))) is not None:
                    hit[k : k + n] = [True] * n
                    found |= own
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), sum(hit), len(found), ids, any(hit)))
    return out


ITEMS = [
    (1, "one TWO three four five six seven eight nine ten eleven"),
    (2, "beta gamma"),
    (3, ""),
    (4, None),
    (None, "its own words"),
    (5, "beta gamma"),
    (6, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma delta " * 20),
]


@pytest.mark.parametrize("block_bytes", [40, 1 << 24])
def test_decontamination_of_odd_documents(spark, odd, none, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("hits", F.lit(1))
    found = decontaminate.contamination(odd, items, block_bytes=block_bytes)
    got = [
        (r.doc_id, r.n_words, sum(b - a for a, b in r.hits or []), len(r["items"] or []),
         hashlib.sha256(",".join(r["items"] or []).encode()).hexdigest(), r.hits is not None)
        for r in found.collect()
    ]
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(str, got)) == sorted(map(str, hits_by_force(docs, ITEMS)))
    assert decontaminate.report(none, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(odd, items.limit(0)).collect())


def longest_by_force(text, items, window=10):
    """Words, place and item of the longest match that holds a window, then the first, then the least item."""
    w, best = words(text), None
    for item_id, item in items:
        v = words(item)
        for i in range(len(w)):
            for j in range(len(v)):
                n = 0
                while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                    n += 1
                if n >= min(window, len(v)):
                    key = (-n, i, item_id is None, item_id or "")
                    best = key if best is None else min(best, key)
    return None if best is None else (-best[0], best[1], best[3] or None)


@pytest.mark.parametrize("block_bytes", [150, 1 << 24])
def test_longest_match_of_every_copy(spark, block_bytes):
    rng = np.random.default_rng(3)
    item = [f"i{k}" for k in range(40)]
    items = [("a", " ".join(item)), ("b", " ".join(item[10:])), ("c", " ".join(item[:30])), ("s", "i3 i4")]
    texts = [" ".join(["x", *item[5:25], "y"])] * 6 + [" ".join(item[12:30]), "none of these", "i3 i4 i5", None]
    for _ in range(10):
        a, n = rng.integers(0, 30), rng.integers(3, 25)
        texts.append(" ".join(["z", *item[a : a + n], "i1", *item[a : a + n - 2]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id string, text string"), block_bytes=block_bytes)
    got = {r.doc_id: r.longest and (r.longest.words, r.longest.doc_at, r.longest.item_id) for r in found.collect()}
    assert got == {k: longest_by_force(t, items) for k, t in enumerate(texts)}


def test_removal_keeps_columns_and_clean_rows(spark, odd):
    items = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    kept = decontaminate.remove_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert kept.where("doc_id in (1, 2)").count() == 0 and kept.count() == odd.count() - 2
    assert {r.hits for r in kept.collect()} == {"keep-4"}


def test_suffix_array_is_sorted_and_longest_match_is_found():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(-1, 3, 4000), -1)
    array = decontaminate.suffix_array(text, 2, 9, 3)
    tuples = []
    for s in array:
        end = s + int(np.argmax(text[s:] < 0))
        tuples.append(tuple(text[s : min(end, s + 9)]))
    assert tuples == sorted(tuples)
    block = decontaminate.Block([("a", b"x y z x y q z")], 3)
    ids = np.array([block.vocabulary.get(w, -1) for w in b"q x y z x y y x".split()] + [-1])
    found, window, length, place = decontaminate.search(ids, decontaminate.suffix_array(ids, 3, 7, 4), block)
    assert sorted(found.tolist()) == [1, 2, 3] and length.max() == 5 and place[length.argmax()] == 1


def test_quality_on_held_out_rows(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    scored = quality.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in scored) / len(scored)
    assert right > 0.93 and all(0 <= r.score <= 1 for r in scored)
    assert sum(r.predicted == 0 and r.quality == 1 for r in scored) <= 0.02 * len(scored)


def test_quality_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(1, 11)] + [(1, None), (None, 1), (99, 0), (2, 1)], "doc_id long, quality int"
    )
    got = quality.report(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (3, 4)}
    assert len(empty) == 1  # null is scored as empty
    assert {r.score for r in quality.report(odd, labels.limit(0)).collect()} == {1.0}
    assert {r.score for r in quality.report(odd, labels.where("quality = 0")).collect()} == {0.0}
    assert quality.report(none, labels).count() == 0
    kept = quality.accepted(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.count() and kept.first().score == "keep-3"


def test_isotonic_is_the_nearest_rising_sequence():
    rng = np.random.default_rng(0)
    values, weights = rng.random(40), rng.integers(1, 5, 40).astype(float)
    fit = quality.isotonic(weights, values)
    assert (np.diff(fit) >= -1e-12).all()
    # No block's mean can be improved: each block's fit is its weighted mean.
    for level in np.unique(fit):
        own = fit == level
        assert np.isclose(level, np.average(values[own], weights=weights[own]))


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_by_force(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.c+d@e.f g@h i@j@k.lm x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0255.000.1.1 1.2.3 4.5.6.7.", "+1+22 333-4444 55+",
    "4111-1111-1111-1111 4111 1111 1111 1112 5500005555555559 37828224631000512345", "🙂é 10.0.0.1 🙂 a@b.co",
    "5 " * 40_000, "x" * 200_000 + "@", "1" * 100_000, "+" * 50_000, "+1 " + "(" * 90_000, "1.1." * 30_000, "a.b-" * 20_000,
    "call 555-123-4567 or token = \"abc123def456ghi789\" ssn 123-45-6789 and john [at] example [dot] org",
    "4" * 16 + "\n+4 12345678\n+4\n12345678", None, "",
]


def test_base_spans_stay_exact(spark, odd, none):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(100 + n, r.text) for n, r in enumerate(odd.collect())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit("x"))
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    for doc_id, text in rows:
        want = base_by_force(text)
        assert got[doc_id].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text and text[:60]
        counts = [got[doc_id][f"n_{k}"] for k in BASE]
        assert counts == [sum(w.startswith(k + ":") for w in want) for k in BASE]
        spans = [s for s in got[doc_id].spans.split(",") if s]
        assert set(want) <= set(spans)
    assert pii.report(none).count() == 0


def test_added_spans_and_redaction(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    spans = pii.report(docs)
    assert spans.where("spans like '%secret:%'").count() > 0
    text = "mail a@b.co now"
    one = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redacted(one).collect()} == {1: "mail [email] now", 2: None}


def test_overlapping_spans_and_short_addresses_are_kept(spark):
    texts = ["password=bob@site.org#Secret99x", "host 2001:db8::1 and ::1, fe80:: or dead::beef.", "std::vector a :: b ::", "1:2:3:4:5::6:7:8:9"]
    docs = spark.createDataFrame(list(enumerate(texts * 5)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert got[0] == "email:9:21,secret:0:31"
    assert got[1] == "ip:5:16,ip:21:24,ip:26:32,ip:36:46"
    assert got[2] == ""
    assert {r.doc_id: r.text for r in pii.redacted(docs).collect()}[0] == "[secret]"
    # A better one overlaps B, B overlaps C: all stay. D lies within B, E has the range of A.
    spans = [("a", 0, 10, 3.0), ("b", 8, 20, 2.0), ("c", 18, 30, 1.0), ("d", 9, 12, 9.0), ("e", 0, 10, 2.5)]
    kind = "chosen array<struct<kind:string,start:int,stop:int,score:double>>"
    kept = spark.createDataFrame([(spans,)], kind).select(pii.outermost("chosen").alias("x")).first().x
    assert [r.kind for r in kept] == ["a", "b", "c"]


def test_trees_learn_and_thresholds_hold():
    rows = [((k, a, b), 100, 100 * (a > 1 and b == 1)) for k in range(3) for a in range(4) for b in range(2)]
    trees = pii.boosted(rows)
    assert all((pii.value_of(trees, x) > 0) == (y > 0) for x, _, y in rows)
    limits = pii.thresholds(rows, trees, 0.9)
    assert set(limits) == {"email", "ip", "card"}
    assert all((pii.value_of(trees, x) >= limits[pii.KINDS[x[0]]]) == (y > 0) for x, _, y in rows)
    assert pii.boosted([]) == []


def test_licences(spark, odd, none):
    texts = [
        "Foo.\nLicensed under the Apache License, Version 2.0.\nBar",
        "x licensed under the apache license version 2 0",
        "LICENSED under the Apache License - Version 2.0! You may not use this file except in compliance with the License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "All rights reserved. Released under the MIT License. All rights reserved.",
        None, "", "All rights reserved. " * 2000,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(4, texts[4])], "doc_id long, text string")
    sentences, rules = licenses.sentence_frame(spark), licenses.rule_frame(spark)
    got = licenses.recognise(docs.withColumn("licences", F.lit(1)), sentences, rules).collect()
    names = sorted((r.doc_id, r.licences) for r in got)
    assert names == [
        (0, ["Apache-2.0"]), (1, []), (2, ["Apache-2.0"]), (3, []), (4, ["MIT", "proprietary"]),
        (4, ["MIT", "proprietary"]), (5, []), (6, []), (7, ["proprietary"]),
    ]
    assert {r.doc_id: r.n_sentences for r in got}[7] == 2000
    assert licenses.recognise(odd, sentences, rules).count() == odd.count()
    assert licenses.recognise(none, sentences, rules).count() == 0
    assert {tuple(r.licences) for r in licenses.recognise(docs, sentences.limit(0), rules).collect()} == {()}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD = """All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""


def wrapped(text, sign=""):
    lines = [x for p in text.split("\n\n") for x in [*textwrap.wrap(p, 70 - len(sign)), ""]]
    return "\n".join((sign + x).rstrip() for x in lines)


def test_wrapped_headers(spark):
    texts = {"MIT": MIT, "Apache-2.0": APACHE, "BSD-3-Clause": BSD, "GPL-3.0-or-later": GPL}
    want = {}
    for licence, text in texts.items():
        # A line before the header that is no sentence, as a file's title or its copyright line.
        for own in (text, wrapped(text), wrapped(text, "# "), "Copyright (c) 2020 Some One\n" + wrapped(text, " * ")):
            want[len(want)] = (own, [licence])
    for own in ("Some title\nThis work is licensed under the GNU General Public\nLicense, version 3.",):
        want[len(want)] = (own, ["GPL-3.0"])
    want[len(want)] = ("Released under the MIT License\n" * 3_000 + "\n" * 50_000, ["MIT"])
    docs = spark.createDataFrame([(k, t) for k, (t, _) in want.items()], "doc_id long, text string")
    got = licenses.recognise(docs, licenses.sentence_frame(spark), licenses.rule_frame(spark)).collect()
    assert {r.doc_id: r.licences for r in got} == {k: v for k, (_, v) in want.items()}


def test_ordered_rules(spark):
    sentences = spark.createDataFrame([("a", "A one."), ("b", "B two."), ("a2", "a ONE")], "sentence_id string, text string")
    rules = licenses.rule_frame(spark, [("AB", ("a", "b")), ("A", ("a",)), ("BA", ("b", "a2")), ("none", ("zz",)), ("e", ())])
    docs = spark.createDataFrame([(1, "A one. B two."), (2, "B two. x. A one."), (3, "A one.")], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.recognise(docs, sentences, rules).collect()}
    assert got == {1: ["AB"], 2: ["BA"], 3: ["A"]}
