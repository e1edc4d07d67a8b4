import math

import pytest
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from tidemark.operators import metrics, models, retrieval, topics


def table(spark, rows):
    return spark.createDataFrame(rows, "truth string, prediction string")


def test_metrics_of_a_small_case(spark):
    m = metrics.confusion(table(spark, [("A", "A"), ("A", "A"), ("B", "A"), ("B", "B")]))
    got = metrics.summary(m).first()
    assert got.accuracy == 0.75 and m.count() == 4
    assert metrics.majority(spark.createDataFrame([("A",), ("A",), ("B",)], "truth string")).first().label == "A"


def test_top_confusions(spark):
    m = spark.createDataFrame([("A", "A", 5), ("A", "B", 1), ("C", "B", 4), ("C", "C", 6), ("B", "C", 2), ("B", "B", 8)], "actual string, predicted string, n long")
    assert tuple(metrics.top_confusions(m, 3).first()) == ("C", "B", 4, 40.0)


def test_calibration_has_all_bins_and_float_edges(spark):
    rows = [("A", [0.3, 0.7]), ("B", [0.3, 0.7]), ("A", [1.0, 0.0]), ("A", [0.5, 0.5])]
    df = spark.createDataFrame(rows, "truth string, probability array<double>")
    bins = metrics.calibration_bins(df, ["A", "B"], 5).collect()
    assert len(bins) == 5 and sum(b.n for b in bins) == 4 and bins[4].n == 1
    got = metrics.calibration_summary(df, ["A", "B"], 5).first()
    assert 0 <= got.expected_calibration_error <= 1 and got.multiclass_log_loss > 0 and got.multiclass_brier_score > 0
    # the third edge of ten is a little above 0.3, which therefore falls below it
    one = spark.createDataFrame([("A", [0.3])], "truth string, probability array<double>")
    assert [b.bin for b in metrics.calibration_bins(one, ["A"]).collect() if b.n] == [2]
    with pytest.raises(ValueError):
        metrics.calibration_bins(df, ["A", "B"], 0)


def test_search_ranks_and_hides_text(spark):
    docs = spark.createDataFrame([(1, "card fee charged twice", "a", "h1"), (2, "loan payment late", "b", "h2"), (3, "mortgage escrow", "c", "h3")], "doc_id long, narrative string, product string, narrative_hash string")
    meta, terms, corpus = retrieval.index(docs, "doc_id", "narrative", ["product", "narrative_hash"], "narrative_hash")
    got = retrieval.search(terms, corpus, meta, " card fee ", 5).collect()
    assert got[0].doc_id == 1 and got[0]["rank"] == 1 and len(got) == 3 and "narrative" not in got[0].asDict()
    for bad in ("  ", ""):
        with pytest.raises(ValueError):
            retrieval.search(terms, corpus, meta, bad)
    with pytest.raises(ValueError, match="repeated"):
        retrieval.index(docs.withColumn("narrative_hash", F.lit("h")), "doc_id", "narrative", [], "narrative_hash")


def test_retrieval_metrics(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b"), (11, [0.9, 0.1], "a"), (12, [0.1, 0.9], "b")], "doc_id long, vector array<double>, product string")
    corpus, test = v.filter("doc_id < 10"), v.filter("doc_id > 10")
    rows = retrieval.judged(retrieval.dense_top_k(test, corpus, 1), test, corpus, "product")
    got = retrieval.summary(rows, corpus, "product").first()
    assert (got.precision_at_k, got.hit_rate_at_k, got.random_reference, got.lift) == (1.0, 1.0, 0.5, 2.0)
    with pytest.raises(ValueError):
        retrieval.require_no_overlap(v, v, "doc_id")


def test_dense_search_meets_blocks_and_keeps_the_order_of_sql(spark):
    """Copies tie by id, undefined similarities come first and missing ones last; no pair is a row of the plan."""
    rows = [(i, [float(i % 7 - 3), float(i % 5), 1.0 + i % 3]) for i in range(3000)] + [(3000, [0.0, 0.0, 0.0]), (3001, None), (3002, [1.0, None, 2.0]), (3003, [])]
    v = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    got = retrieval.dense_top_k(v.filter("doc_id % 500 = 0 OR doc_id >= 3000"), v, 4)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()

    def unit(x):
        size = math.sqrt(sum(y * y for y in x if y is not None))
        return [y and y / size if size else math.nan for y in x]

    units = {i: unit(x) if x else [] for i, x in rows}
    for q in sorted({r.query_id for r in got.collect()} | {0, 3000, 3001, 3002, 3003}):
        want = []
        for i, u in units.items():
            terms = [a * b for a, b in zip(units[q], u) if a is not None and b is not None]
            if i != q:
                total = 0.0
                for t in terms:
                    total += t
                want.append((2.0 if not terms else -9.0 if math.isnan(total) else -total, i))
        mine = [(2.0 if r.similarity is None else -9.0 if math.isnan(r.similarity) else -r.similarity, r.doc_id) for r in got.filter(F.col("query_id") == q).orderBy("rank").collect()]
        assert mine == sorted(want)[:4], q
    assert retrieval.dense_top_k(v.filter("doc_id = 2"), v.filter("doc_id < 3000"), 1, own=True).first().doc_id == 2
    assert retrieval.dense_top_k(v.filter("doc_id = 2"), v.filter("doc_id < 3000"), 1).first().doc_id == 107


def test_judged_search_has_no_pairs_as_rows(spark):
    v = spark.range(400).select(F.col("id").alias("doc_id"), F.array(F.sin("id"), F.cos("id")).alias("vector"), (F.col("id") % 3).cast("string").alias("product"))
    corpus, test = v.filter("doc_id % 20 <> 0"), v.filter("doc_id % 20 = 0")
    rows = retrieval.judged(retrieval.dense_top_k(test, corpus, 5), test, corpus, "product")
    for out in (retrieval.summary(rows, corpus, "product"), retrieval.by_class(rows)):
        assert "zip_with" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert retrieval.summary(rows, corpus, "product").first().query_rows == 20


def test_topics(spark):
    texts = [(i, t) for i, t in enumerate(["card fee", "card fee late", "card charge fee", "loan payment", "loan rate payment", "loan payment due"])]
    df = spark.createDataFrame(texts, "id long, narrative string")
    f = models.fit_features(df, "narrative", min_df=1, ngram_max=1)
    rows = f.transform(df, "narrative")
    model, tried = topics.fit_candidates(rows, [2], n_init=1, max_iterations=10)
    assert tried[0].clusters == 2 and tried[0].passes_size_guardrail
    assert all(len(r.top_terms) == 3 for r in topics.top_terms(model, f.vocabulary, spark, 3).collect())
    out = topics.assign(model, rows, ["id"])
    assert out.columns == ["id", "topic_id"] and out.count() == 6
    sizes = topics.cluster_sizes(spark.createDataFrame([(0,), (0,), (2,)], "topic_id int"), 3)
    assert [r.rows for r in sizes.orderBy("topic_id").collect()] == [2, 0, 1]
    with pytest.raises(ValueError):
        topics.fit_candidates(rows, [1])


def test_features_are_fitted_in_one_pass_over_the_texts(spark):
    """The vocabulary goes by count, then term, and the idf is that of Spark's estimator."""
    df = spark.createDataFrame([("bb aa cc",), ("aa bb",), ("aa dd dd",), (None,)], "narrative string")
    f = models.fit_features(df, "narrative", min_df=1, max_features=3, ngram_max=1)
    assert f.vocabulary == ["aa", "bb", "dd"]
    plain = IDF(inputCol="__counts", outputCol="__idf").fit(f.counts.transform(f.terms(df, "narrative")))
    assert f.idf.idf.toArray().tolist() == pytest.approx(plain.idf.toArray().tolist()) and list(f.idf.docFreq) == list(plain.docFreq) and f.idf.numDocs == plain.numDocs
    assert f.transform(df.withColumn("more", F.lit(1)), "narrative", ["more"]).columns == ["more", "features"]


def test_classifier_learns_and_checks_c(spark):
    df = spark.createDataFrame([("card fee", "card"), ("card charge", "card"), ("loan rate", "loan"), ("loan due", "loan")], "narrative string, product string")
    f = models.fit_features(df, "narrative", min_df=1, ngram_max=1)
    rows = f.transform(df, "narrative")
    model = models.fit_classifier(rows, "product", c=10.0, max_iterations=20)
    assert metrics.summary(metrics.confusion(models.predict(model, rows, "product"))).first().accuracy == 1.0
    with pytest.raises(ValueError):
        models.fit_classifier(rows, "product", c=0)
