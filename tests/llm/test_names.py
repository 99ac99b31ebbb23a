"""Extra columns of any name pass through the operators that keep the documents' columns."""

import pytest
from pyspark.sql import functions as F

from tidegate.llm import bpe, decontaminate, line_dedup, quality, simhash
from tidegate.llm.queries import BYTE_BPE

NAMES = ["score", "_score", "__score", "kept_id", "a.b", "k`q", "dedup_removed", "_dedup_text_key", "kept_hits", "hits", "Items", "node"]


@pytest.fixture(scope="module")
def named(spark):
    rows = [(1, "one line of words\nanother line here"), (2, "one line of words\nsome other text"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in NAMES])


def kept(df, source):
    assert df.columns == source.columns
    rows = df.collect()
    assert all(list(r)[2:] == [f"{n}-{r.doc_id}" for n in NAMES] for r in rows)
    return {r.doc_id: r.text for r in rows}


def test_names_pass_through(spark, named):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, "some other text")], "item_id long, text string")
    texts = {r.doc_id: r.text for r in named.collect()}
    assert kept(quality.accepted(named, labels), named) == texts
    assert kept(line_dedup.deduplicated(named), named) == {**texts, 2: "some other text"}
    assert kept(simhash.one_of_each_group(named), named) == texts
    assert kept(decontaminate.remove_contaminated(named, items), named) == {k: texts[k] for k in (1, 3)}
    back = bpe.decode(bpe.encode(named, BYTE_BPE), BYTE_BPE)
    assert kept(back.select(*[F.col(q) for q in ("doc_id", "text", *(f"`{n.replace('`', '``')}`" for n in NAMES))]), named) == texts
    assert all(r.decoded == (r.text or "") for r in back.collect())
