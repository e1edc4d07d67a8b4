"""Topics by K-Means over TF-IDF vectors: candidates, choice, description, assignment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.guards import require


@dataclass(frozen=True)
class Candidate:
    """What one number of clusters gave."""

    clusters: int
    cosine_silhouette: float
    inertia: float
    minimum_cluster_rows: int
    maximum_cluster_rows: int
    minimum_cluster_fraction: float
    empty_clusters: int
    passes_size_guardrail: bool


def cluster_sizes(assigned: DataFrame, clusters: int, col: str = "topic_id") -> DataFrame:
    """topic_id, rows of every cluster, empty ones included."""
    counts = assigned.groupBy(F.col(col).cast("int").alias("topic_id")).agg(F.count("*").alias("rows"))
    every = assigned.sparkSession.range(clusters).select(F.col("id").cast("int").alias("topic_id"))
    return every.join(F.broadcast(counts), "topic_id", "left").select("topic_id", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def fit_candidates(vectors: DataFrame, candidates: list[int], *, max_iterations: int = 100, n_init: int = 5, sample_size: int = 5000, minimum_fraction: float = 0.002, seed: int = 42) -> tuple[KMeansModel, list[Candidate]]:
    """The best K-Means model over unit vectors in column features, and all candidates' figures.

    Of each number of clusters the start of lowest cost counts.  Among those
    whose smallest cluster is large enough (all, if none is), the greatest cosine
    silhouette wins, then the fewest clusters.
    """
    require(bool(candidates) and all(c >= 2 for c in candidates), "candidates must be integers of at least 2")
    require(0 <= minimum_fraction < 1, "the minimum fraction must be in [0, 1)")
    require(sample_size >= 2, "the evaluation sample must have at least 2 rows")
    vectors = vectors.cache()
    total = vectors.count()
    fitted = []
    for k in candidates:
        models = [KMeans(k=k, seed=seed + i, maxIter=max_iterations, featuresCol="features", predictionCol="topic_id").fit(vectors) for i in range(n_init)]
        model = min(models, key=lambda m: m.summary.trainingCost)
        assigned = model.transform(vectors)
        sizes = [r.rows for r in cluster_sizes(assigned, k).collect()]
        sample = assigned.orderBy(F.xxhash64("features")).limit(sample_size) if total > sample_size else assigned
        alike = sum(s > 0 for s in sizes) < 2
        score = 0.0 if alike else ClusteringEvaluator(predictionCol="topic_id", featuresCol="features", distanceMeasure="cosine").evaluate(sample)
        low = min(sizes)
        fitted.append((model, Candidate(k, round(score, 6), round(model.summary.trainingCost, 3), low, max(sizes), round(low / total, 6), sizes.count(0), low / total >= minimum_fraction)))
    vectors.unpersist()
    pool = [x for x in fitted if x[1].passes_size_guardrail] or fitted
    best = max(pool, key=lambda x: (x[1].cosine_silhouette, -x[1].clusters))
    return best[0], [c for _, c in fitted]


def top_terms(model: KMeansModel, vocabulary: list[str], spark, most: int = 10) -> DataFrame:
    """topic_id, top_terms: the terms of greatest centre weight, descending."""
    require(most > 0, "the number of terms must be positive")
    rows = []
    for topic, centre in enumerate(model.clusterCenters()):  # one centre for each topic
        order = sorted(range(len(centre)), key=lambda i: (-centre[i], vocabulary[i]))[:most]
        rows.append((topic, [vocabulary[i] for i in order]))
    return spark.createDataFrame(rows, "topic_id int, top_terms array<string>")


def describe(assigned: DataFrame, clusters: int, label_col: str = "product") -> DataFrame:
    """topic_id, historical_rows, dominant_product, dominant_product_share, product_count; nulls when empty."""
    per = assigned.groupBy(F.col("topic_id").cast("int").alias("topic_id"), F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("topic_id").orderBy(F.col("label").isNull(), F.desc("n"), "label"))
    stats = per.withColumn("place", place).groupBy("topic_id").agg(
        F.sum("n").alias("rows"),
        F.max(F.when((F.col("place") == 1) & F.col("label").isNotNull(), F.col("label"))).alias("dominant_product"),
        F.max(F.when((F.col("place") == 1) & F.col("label").isNotNull(), F.col("n"))).alias("top"),
        F.count("label").alias("product_count"),
    )
    every = assigned.sparkSession.range(clusters).select(F.col("id").cast("int").alias("topic_id"))
    return every.join(F.broadcast(stats), "topic_id", "left").select(
        "topic_id", F.coalesce("rows", F.lit(0)).cast("long").alias("historical_rows"), "dominant_product", F.round(F.col("top") / F.col("rows"), 6).alias("dominant_product_share"), F.coalesce("product_count", F.lit(0)).cast("long").alias("product_count")
    )


def assign(model, docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and topic_id of every document; texts are not among them."""
    return model.transform(docs).select(*keep, F.col("topic_id").cast("int").alias("topic_id"))
