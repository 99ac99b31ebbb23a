import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import groups_by_force, print_by_force, removed_by_force
from tests.llm.test_filters import hits_by_force
from tidegate.llm import bpe, quality
from tidegate.llm.common import table
from tidegate.llm.queries import BYTE_BPE, QUERIES


@pytest.fixture(scope="module")
def kept(spark, small, tmp_path_factory):
    """What each stage kept, by number; 0 is the input."""
    docs = table(spark, small, "documents")
    out = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, out[-1], small).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").orderBy("doc_id").collect()]


def test_stages_and_columns(kept):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
    assert all(k.columns == kept[0].columns for k in kept[:-1])


def test_classifier_stage(spark, small, kept):
    labels = table(spark, small, "labels")
    model = quality.fit(kept[0], labels)
    scores = {r.doc_id: r.score for r in quality.scored(kept[0], model).collect()}
    assert {d for d, _ in rows(kept[1])} == {d for d, s in scores.items() if s >= quality.THRESHOLD}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good - {d for d, _ in rows(kept[1])}) <= 0.05 * len(good)


def test_line_stage(kept):
    gone = removed_by_force(rows(kept[1]))
    want = [
        (d, "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)) for d, t in rows(kept[1])
    ]
    assert rows(kept[2]) == want
    assert kept[2].where(F.col("n_chars") != F.length("text")).count() == 0


def test_near_stage_keeps_one_of_each(kept):
    before = {d: print_by_force(t) for d, t in rows(kept[2])}
    groups = groups_by_force(before, lambda a, b: (a ^ b).bit_count() <= 3)
    assert [d for d, _ in rows(kept[3])] == sorted(set(groups.values()))
    assert set(rows(kept[3])) <= set(rows(kept[2]))


def test_benchmark_stage(spark, small, kept):
    items = [tuple(r) for r in table(spark, small, "benchmark").select("item_id", "text").collect()]
    dirty = {r[0] for r in hits_by_force(rows(kept[3]), items) if r[-1]}
    assert rows(kept[4]) == [(d, t) for d, t in rows(kept[3]) if d not in dirty]


def test_encoding_stage(kept):
    texts = {r.doc_id: r.decoded for r in bpe.decode(kept[5].select("doc_id", "ids"), BYTE_BPE).collect()}
    assert texts == dict(rows(kept[4]))


def test_queries_are_registered(spark, small):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert corpus_pipeline.run(spark, small).count() > 0
