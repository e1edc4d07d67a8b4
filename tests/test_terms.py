import pytest
from pyspark.sql import functions as F

from tidemark.operators import tfidf

TEXTS = ["card fee card", "card fee late", None, "", "loan payment late fee", "Card fee", "loan rate Loan loan", "x", "fee"]


def made(spark, repeated):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    if repeated:
        rows += [(0, "fee card"), (4, None), (None, "card"), (None, "fee")]
    return spark.createDataFrame(rows, "id long, text string")


def same(got, want):
    key = lambda df: sorted(((r.doc_id if r.doc_id is not None else -1, r.term, r.w) for r in df.select("doc_id", "term", F.round("weight", 9).alias("w")).collect()))
    assert key(got) == key(want) and got.columns == want.columns and got.dtypes == want.dtypes


@pytest.mark.parametrize(
    "repeated, most, limits",
    [(False, 1, {"min_df": 4}), (True, 2, {}), (False, 1, {"min_df": 999}), (False, 2, {"max_features": 3, "max_df": 0.7}), (True, 1, {"max_features": 10**6})],
)
def test_weights_without_rows_of_terms_equal_the_plain_ones(spark, repeated, most, limits, monkeypatch):
    monkeypatch.setattr(tfidf, "GROUP_BYTES", 256)
    monkeypatch.setattr(tfidf, "FIRST_NUMBERS", 12)
    docs = made(spark, repeated)
    corpus = tfidf.Corpus(docs, "id", "text", ngram_max=most, stop=["late"])
    counts = tfidf.term_counts(docs, "id", "text", ngram_max=most, stop=["late"])
    plain = tfidf.vocabulary(counts, docs.count(), **limits)
    assert sorted(corpus.vocabulary(**limits).collect()) == sorted(plain.collect())
    same(corpus.weights(**limits), tfidf.weights(counts, plain))


def test_runs_of_three_words_keep_to_their_texts(spark):
    docs = spark.createDataFrame([(1, "aa bb cc dd"), (2, "ee"), (3, "aa bb cc")], "id long, text string")
    got = {(r.term, r.df) for r in tfidf.Corpus(docs, "id", "text", ngram_max=3).vocabulary().collect()}
    assert got == {("aa", 2), ("bb", 2), ("cc", 2), ("dd", 1), ("ee", 1), ("aa bb", 2), ("bb cc", 2), ("cc dd", 1), ("aa bb cc", 2), ("bb cc dd", 1)}


def test_rows_of_document_and_term_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} other") for i in range(50)], "id long, text string")
    plan = tfidf.Corpus(docs, "id", "text", ngram_max=2).weights(max_features=5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = tfidf.Corpus(docs, "id", "text", ngram_max=1).weights(min_df=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "explode" not in plan
