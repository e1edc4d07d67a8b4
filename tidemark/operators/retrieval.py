"""Retrieval of similar earlier records by exact cosine, and its evaluation by label agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import nearest
from tidemark.operators.guards import require
from tidemark.operators.tfidf import Corpus, term_counts, weights

#: Rows of a range of the corpus at most (and bytes of its vectors) and at least; queries of a tile on average.
RANGE_ROWS, RANGE_BYTES, LEAST_RANGE_ROWS, TILE_ROWS = 1 << 17, 1 << 26, 1024, 1 << 16


def index(docs: DataFrame, id_col: str, text_col: str, keep: list[str], hash_col: str | None = None, **fit) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metadata without text, vocabulary, and weights (doc_id, term, weight) of a corpus.

    Repeated hashes are an error.
    """
    if hash_col is not None and not docs.groupBy(hash_col).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError("the corpus holds repeated hashes")
    shape = {k: v for k, v in fit.items() if k in ("pattern", "ngram_max", "stop")}
    limits = {k: v for k, v in fit.items() if k in ("min_df", "max_df", "max_features")}
    corpus = Corpus(docs, id_col, text_col, **shape)
    return docs.select(F.col(id_col).alias("doc_id"), *keep), corpus.vocabulary(**limits), corpus.weights(**limits)


def by_terms(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """query_id, doc_id, similarity of all pairs that share a term; both hold (doc_id, term, weight)."""
    q = queries.select(F.col("doc_id").alias("query_id"), "term", F.col("weight").alias("wq"))
    return q.join(corpus, "term").groupBy("query_id", "doc_id").agg(F.sum(F.col("wq") * F.col("weight")).alias("similarity"))


def search(terms: DataFrame, corpus: DataFrame, metadata: DataFrame, text: str, k: int = 5, **shape) -> DataFrame:
    """rank, similarity and metadata of the k most similar documents to one text; blank texts are an error."""
    require(bool(text and text.strip()), "the query is blank")
    require(k > 0, "k must be positive")
    spark = corpus.sparkSession
    query = spark.createDataFrame([(0, text.strip())], "doc_id long, narrative string")
    asked = weights(F.broadcast(term_counts(query, "doc_id", "narrative", **shape)), terms)  # the terms of one text
    found = by_terms(F.broadcast(asked), corpus)
    rows = metadata.join(found, "doc_id", "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
    top = rows.orderBy(F.desc("similarity"), "doc_id").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("similarity"), "doc_id"))  # at most k rows
    return top.select(rank.alias("rank"), F.round("similarity", 6).alias("similarity"), *metadata.columns)


def dense_top_k(queries: DataFrame, corpus: DataFrame, k: int, own: bool = False) -> DataFrame:
    """query_id, rank, doc_id, similarity by exact cosine of dense vectors (doc_id, vector).

    Both are rows: a task holds one range of the corpus and streams a tile of the
    queries past it, keeping k rows for each query.  ``own`` lets a query meet the
    document of its own id.
    """
    require(k > 0, "k must be positive")
    held = corpus.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width")).first()
    most = max(LEAST_RANGE_ROWS, min(RANGE_ROWS, RANGE_BYTES // (8 * max(1, held.width or 1))))
    ranges = max(1, -(-held.rows // most), min(-(-held.rows // LEAST_RANGE_ROWS), 3 * corpus.sparkSession.sparkContext.defaultParallelism))
    tiles = max(1, -(-queries.count() // TILE_ROWS))
    dealt = lambda n: F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")
    named = lambda df: df if own else df.filter("doc_id IS NOT NULL")
    c = named(corpus).select(dealt(ranges).alias("range"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.lit(False).alias("asks"), "doc_id", "vector")
    q = named(queries).select(F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range"), dealt(tiles).alias("tile"), F.lit(True).alias("asks"), "doc_id", "vector")
    rows = c.unionByName(q).repartition("range", "tile").sortWithinPartitions("range", "tile", "asks", "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(lambda batches: nearest.met(batches, k, own), f"query_id {kind}, doc_id {kind}, similarity double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "similarity")


def sampled_queries(docs: DataFrame, id_col: str, label_col: str, per_class: int, seed: int = 42) -> DataFrame:
    """At most per_class rows of each label, in the order of a seeded hash of the id."""
    require(per_class > 0, "per_class must be positive")
    place = F.row_number().over(Window.partitionBy(label_col).orderBy(F.sha2(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))), 256), id_col))
    return docs.withColumn("__place", place).filter(F.col("__place") <= per_class).drop("__place")


def require_no_overlap(test: DataFrame, corpus: DataFrame, hash_col: str) -> None:
    shared = test.join(corpus.select(hash_col).distinct(), hash_col, "left_semi").count()
    require(shared == 0, f"the test rows share {shared} texts with the corpus")


def judged(ranked: DataFrame, queries: DataFrame, corpus: DataFrame, label_col: str) -> DataFrame:
    """query_id, label, precision, hit, reciprocal_rank: precision divides by the rows that were ranked."""
    q = queries.select(F.col("doc_id").alias("query_id"), F.col(label_col).alias("label"))
    d = corpus.select("doc_id", F.col(label_col).alias("found"))
    rows = ranked.join(q, "query_id").join(d, "doc_id")
    good = F.col("label") == F.col("found")
    return rows.groupBy("query_id", "label").agg(
        (F.count_if(good) / F.count("*")).alias("precision"),
        F.max(good.cast("int")).alias("hit"),
        F.coalesce(1.0 / F.min(F.when(good, F.col("rank"))), F.lit(0.0)).alias("reciprocal_rank"),
    )


def summary(rows: DataFrame, corpus: DataFrame, label_col: str) -> DataFrame:
    """query_rows, precision_at_k, hit_rate_at_k, mean_reciprocal_rank, random_reference, lift of judged rows."""
    priors = class_priors(corpus, label_col)
    all_rows = rows.join(F.broadcast(priors), "label", "left").agg(
        F.count("*").alias("query_rows"),
        F.avg("precision").alias("p"),
        F.avg("hit").alias("h"),
        F.avg("reciprocal_rank").alias("r"),
        F.avg(F.coalesce("prior", F.lit(0.0))).alias("x"),
    )
    return all_rows.select(
        "query_rows",
        F.round("p", 6).alias("precision_at_k"),
        F.round("h", 6).alias("hit_rate_at_k"),
        F.round("r", 6).alias("mean_reciprocal_rank"),
        F.round("x", 6).alias("random_reference"),
        F.round(F.try_divide("p", "x"), 4).alias("lift"),
    )


def by_class(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count("*").alias("queries"), F.round(F.avg("precision"), 6).alias("precision_at_k"), F.round(F.avg("hit"), 6).alias("hit_rate_at_k"), F.round(F.avg("reciprocal_rank"), 6).alias("mean_reciprocal_rank"))


def class_priors(corpus: DataFrame, label_col: str) -> DataFrame:
    """label, prior: its share of the corpus."""
    per = corpus.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("n").alias("all")))).select("label", (F.col("n") / F.col("all")).alias("prior"))
