"""The corpus pipeline, stage by stage."""

import corpus_pipeline
from tidemark.llm import decontam, neardup, quality
from tests.llm.test_pairs import brute_components
from tests.llm.test_text_stages import brute_hits

PATH = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    after = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, PATH)
        docs = neardup.written(docs, "test-stage")
        after.append(docs)
    assert all(d.columns == columns for d in after[:-1])
    good = {r.doc_id: r.text for r in after[0].collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    assert all(i in good for i, q in labels.items() if q == 1)
    root = brute_components(sorted(good.items()))
    alone = {r.doc_id: r.text for r in after[1].collect()}
    assert set(alone) == {i for i in good if root[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in after[2].collect()}
    assert clean == {i for i, t in alone.items() if brute_hits(t, items)[1] == 0}
    mixed = [r.doc_id for r in after[3].collect()]
    assert set(mixed) <= clean and max(map(mixed.count, mixed)) <= 3
    out = after[4].collect()
    assert sorted(r.doc_id for r in out) == sorted(mixed)
    ends = sorted((r.start, r.n_tokens) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:])) and ends[0][0] == 0


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, PATH)
        assert docs.count() == 0


def test_registered_queries_name_every_operator():
    from tidemark.llm import registry

    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 11))
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert decontam.ORACLE and quality.THRESHOLD == 0.3
