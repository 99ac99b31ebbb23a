"""Licence recognition by sentences: known sentences in the order a rule asks for.

Texts are cut into sentences, which are normalised (lower case, runs of other than letters and digits to one space) and
looked up among known licence sentences by an equi-join. A sentence may be wrapped over lines, also behind comment signs:
looked up are each of its lines and what it says from any of its lines to its end. A document's identifiers in text order are then matched
against the rules, each an ordered list of sentence identifiers; a rule holds where its identifiers occur one right
after the other. A licence's rule names the licence found; a rule whose match lies inside that of a longer rule is
dropped, so that the shorter one does not stand beside the licence it is part of.

Only sentences with a known digest leave the scan, so what is shuffled and gathered is what was recognised. All of it
is DataFrame functions.

Cases: a null or empty text has no sentences and no licences. Repeated documents (equal id and text) each keep their
row. A sentence that two identifiers share counts for both. Rules with unknown identifiers never hold; empty rules
hold nowhere. Other columns of the documents are not used. Very long texts only cost their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.scans import let, running
from tidegate.session import written

# Licence sentences as their owners write them, and the licence that a list of them stands for.
SENTENCES = (
    ("mit-released", "Released under the MIT License."),
    ("mit-granted", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies"),
    ("apache-2.0-licensed", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-not-use", "you may not use this file except in compliance with the License."),
    ("gpl-3.0-licensed", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-free-software", "This program is free software: you can redistribute it and/or modify it"),
    ("cc-by-nc-4.0-licensed", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-licensed", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0-licensed", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "mit-copies",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    (
        "mit-as-is",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "mit-liability",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
    ),
    ("apache-2.0-obtain", "You may obtain a copy of the License at"),
    (
        "apache-2.0-as-is",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    (
        "apache-2.0-see",
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "bsd-source",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
    ),
    (
        "bsd-binary",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "bsd-names",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "bsd-as-is",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED.",
    ),
    (
        "isc-permission",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl-2.0-copy",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    *(
        (
            f"{name}-{version}.0-or-later",
            f"This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} "
            f"License as published by the Free Software Foundation, either version {version} of the License, or (at your "
            "option) any later version.",
        )
        for name, kind, what, mark, version in (
            ("gpl", "General Public", "program", ":", 3),
            ("gpl", "General Public", "program", ";", 2),
            ("lgpl", "Lesser General Public", "library", ":", 3),
            ("agpl", "Affero General Public", "program", ":", 3),
        )
    ),
)
RULES = (
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-granted", "mit-notice")),
    ("Apache-2.0", ("apache-2.0-licensed",)),
    ("Apache-2.0", ("apache-2.0-licensed", "apache-2.0-not-use")),
    ("GPL-3.0", ("gpl-3.0-licensed",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-licensed",)),
    ("CC-BY-4.0", ("cc-by-4.0-licensed",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-licensed",)),
    ("proprietary", ("all-rights-reserved",)),
    ("MIT", ("mit-grant", "mit-copies")),
    ("MIT", ("mit-grant", "mit-copies", "mit-as-is", "mit-liability")),
    ("MIT", ("all-rights-reserved", "mit-grant", "mit-copies")),
    ("Apache-2.0", ("apache-2.0-header",)),
    ("Apache-2.0", ("apache-2.0-header", "apache-2.0-obtain", "apache-2.0-as-is", "apache-2.0-see")),
    ("BSD-2-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", ("all-rights-reserved", "bsd-conditions", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("BSD-3-Clause", ("all-rights-reserved", "bsd-conditions", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("ISC", ("isc-permission",)),
    ("MPL-2.0", ("mpl-2.0-copy",)),
    ("GPL", ("gpl-free-software",)),
    ("GPL-3.0-or-later", ("gpl-3.0-or-later",)),
    ("GPL-2.0-or-later", ("gpl-2.0-or-later",)),
    ("LGPL-3.0-or-later", ("lgpl-3.0-or-later",)),
    ("AGPL-3.0-or-later", ("agpl-3.0-or-later",)),
)


def sentence_frame(spark: SparkSession, sentences=SENTENCES) -> DataFrame:
    return spark.createDataFrame(list(sentences), "sentence_id string, text string")


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [(n, licence, list(ids)) for n, (licence, ids) in enumerate(rules)]
    return spark.createDataFrame(rows, "rule long, licence string, sentence_ids array<string>")


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def sentences_of(text: Column) -> Column:
    """Sentences end at a line without letters or digits, or after ``.``, ``!`` or ``?`` before white space."""
    return F.split(text, r"\n[^\p{L}\p{N}\n]*+(?=\n)|(?<=[.!?])\s+")


def spoken_in(sentence: Column, longest: int) -> Column:
    """``line, lines, spoken`` of what a sentence may say, normalised: each of its lines, and what it says from a line to
    its end, where that is at most ``longest`` characters."""
    lines = F.filter(F.transform(F.split(sentence, r"\n"), normalised), lambda x: x != "")
    alone = F.transform(
        lines, lambda x, i: F.struct(i.alias("line"), F.lit(1).alias("lines"), x.alias("spoken"))
    )
    # From the last line on; a line has a character and a space at least, which bounds how many are looked at.
    count = F.size(lines)
    tail = F.reverse(F.slice(lines, F.greatest(count - longest // 2, F.lit(1)), longest // 2 + 1))
    kind = "array<struct<line:int,lines:int,spoken:string>>"
    start = F.struct(F.lit("").alias("said"), F.lit(0).alias("n"), F.array().cast(kind).alias("out"))

    def add(state: Column, line: Column) -> Column:
        fits = F.length(state["said"]) <= longest
        said = F.when(fits, F.trim(F.concat_ws(" ", line, state["said"]))).otherwise(state["said"])
        n = state["n"] + 1
        more = fits & (n > 1) & (F.length(said) <= longest)
        one = F.struct((count - n).alias("line"), n.alias("lines"), said.alias("spoken"))
        out = F.when(more, F.concat(state["out"], F.array(one).cast(kind))).otherwise(state["out"])
        return F.struct(said.alias("said"), n.alias("n"), out.alias("out"))

    joined = F.when(count > 1, F.aggregate(tail, start, add, lambda s: s["out"])).otherwise(F.array().cast(kind))
    return F.concat(alone.cast(kind), joined)


def recognise(documents: DataFrame, sentences: DataFrame, rules: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_sentences`` known, ``sentence_ids`` in text order, ``licences`` found (sorted)."""
    known = (
        sentences.select("sentence_id", normalised(F.col("text")).alias("known"))
        .where("known != '' and sentence_id is not null")
        .groupBy(F.xxhash64("known").alias("code"), "known")
        .agg(F.sort_array(F.collect_set("sentence_id")).alias("ids"))
    )
    # Written, so that its measured size decides whether it is sent to all tasks or the sentences are dealt.
    known = written(known, "sentences")
    longest = known.agg(F.max(F.length("known"))).first()[0] or 0
    keyed = documents.select("doc_id", F.col("text"), F.xxhash64("text").alias("text_key"))
    # Equal documents are one here; each row gets the result back by its id and text key.
    cut = keyed.select("doc_id", "text_key", F.posexplode(sentences_of(F.col("text"))).alias("at", "sentence"))
    spoken = cut.select("doc_id", "text_key", "at", F.explode(spoken_in(F.col("sentence"), longest)).alias("s"))
    spoken = spoken.select("doc_id", "text_key", "at", "s.*")
    matched = (
        spoken.join(known, (F.xxhash64("spoken") == F.col("code")) & (F.col("spoken") == F.col("known")))
        .groupBy("doc_id", "text_key", "at", "line", "lines")
        .agg(F.first("ids").alias("ids"))
    )
    # Of what is said in several lines the longest counts, and no single line inside it.
    said = F.struct("line", "lines", "ids")
    found = (
        matched.groupBy("doc_id", "text_key", "at")
        .agg(F.sort_array(F.collect_list(said)).alias("said"), F.min(F.when(F.col("lines") > 1, F.col("line"))).alias("whole"))
        .withColumn(
            "said",
            F.expr("filter(said, s -> whole is null or s.line < whole or (s.line = whole and s.lines > 1))"),
        )
        .select("doc_id", "text_key", F.explode("said").alias("s"), F.struct("at", "s.line").alias("at"), F.col("s.ids").alias("ids"))
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("seen"))
        .withColumn("order", F.transform("seen", lambda s: s["ids"]))
    )
    # The rules are rows; each meets the documents that hold its first sentence.
    first = rules.where("size(sentence_ids) > 0").select(
        "rule", "licence", "sentence_ids", F.col("sentence_ids")[0].alias("head")
    )
    first = written(first, "rules")
    heads = found.select(
        "doc_id", "text_key", "order", F.explode(F.array_distinct(F.flatten("order"))).alias("head")
    )
    spans = heads.join(first, "head").select("doc_id", "text_key", "licence", _spans().alias("spans"))
    spans = spans.select("doc_id", "text_key", "licence", F.explode("spans").alias("span"))
    held = spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("span", "licence")).alias("held"))
    licences_of = F.array_sort(F.array_distinct(F.transform(_longest(F.col("held")), lambda x: x["licence"])))
    licences = held.select(
        F.col("doc_id").alias("held_id"),
        F.col("text_key").alias("held_key"),
        licences_of.alias("licences"),
    )
    seen = found.select(
        F.col("doc_id").alias("seen_id"),
        F.col("text_key").alias("seen_key"),
        F.size("order").cast("long").alias("n_sentences"),
        F.flatten("order").alias("sentence_ids"),
    )
    result = seen.join(licences, F.expr("seen_id <=> held_id and seen_key = held_key"), "left")
    none = F.array().cast("array<string>")
    return (
        documents.select("doc_id", F.xxhash64("text").alias("text_key"))
        .join(result, F.expr("doc_id <=> seen_id and text_key = seen_key"), "left")
        .select(
            "doc_id",
            F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"),
            F.coalesce("sentence_ids", none).alias("sentence_ids"),
            F.coalesce("licences", none).alias("licences"),
        )
    )


def _spans() -> Column:
    """Where the rule's identifiers follow each other in ``order``, as (start, stop) of sentence positions."""
    return F.expr(
        """transform(
            filter(
                sequence(0, size(order) - 1),
                i -> forall(
                    sequence(0, size(sentence_ids) - 1),
                    j -> i + j < size(order) and coalesce(array_contains(get(order, i + j), sentence_ids[j]), false)
                )
            ),
            i -> named_struct('start', i, 'stop', i + size(sentence_ids))
        )"""
    )


def _longest(held: Column) -> Column:
    """Those of ``span, licence`` whose span no longer one contains.

    Sorted by start, longer ones first, a longer one around a span stands before it: it ends later, or there after an
    earlier start.
    """
    order = F.sort_array(
        F.transform(
            held,
            lambda a: F.struct(a["span"]["start"].alias("start"), (-a["span"]["stop"]).alias("back"), a["licence"].alias("licence")),
        )
    )
    # Stop and start of the furthest of the spans before, as one number.
    reach = lambda a: F.shiftleft((-a["back"]).cast("long"), 32) - a["start"]

    def kept(spans: Column) -> Column:
        before = let(F.transform(spans, reach), lambda own: running(own, F.lit(-1).cast("long"), F.greatest))
        judged = F.zip_with(spans, before, lambda a, r: F.struct(a["licence"].alias("licence"), (r <= reach(a)).alias("out")))
        return F.filter(judged, lambda x: x["out"])

    return let(order, kept)


def report(documents: DataFrame, sentences: DataFrame, rules: DataFrame) -> DataFrame:
    found = recognise(documents, sentences, rules)
    return found.select(
        "doc_id",
        "n_sentences",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )
