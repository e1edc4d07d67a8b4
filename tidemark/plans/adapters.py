"""The engine's contracts (assignments, narratives, predictions, vectors) over the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.weekly import ScoreRules

#: Complete weeks of the sample orders.
MONITOR = (dt.date(1995, 1, 2), dt.date(2001, 7, 29))
#: The sample tables hold few rows a week.
RULES = ScoreRules(minimum_weekly_count=5, minimum_share_increase=0.01, robust_z_threshold=2.0, scale_floor=0.01, persistence_required_weeks=1)
WINDOWS = {
    "train": (dt.date(2023, 9, 1), dt.date(2023, 12, 31)),
    "validation": (dt.date(2024, 1, 1), dt.date(2024, 2, 29)),
    "test": (dt.date(2024, 3, 1), dt.date(2024, 3, 31)),
}
CLASSES = ["de", "en", "es", "fr"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """complaint_id, date_received, product, issue, company, state, submitted_via, topic_id from orders."""
    o = _read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("complaint_id"),
        F.col("o_orderdate").cast("date").alias("date_received"),
        F.col("o_orderstatus").alias("product"),
        F.col("o_orderpriority").alias("issue"),
        F.concat(F.lit("company "), (F.col("o_custkey") % 10).cast("string")).alias("company"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 7).cast("string")).alias("state"),
        F.lit("Web").alias("submitted_via"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("topic_id"),
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic_id, top_terms: the words of the order priority of a topic; the last topic has no description."""
    o = _read(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    words = F.split(F.lower("o_orderpriority"), r"[ -]+")
    rows = o.select((F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("topic_id"), F.concat(words, F.array(*map(F.lit, ("order", "status", "week", "more")))).alias("top_terms"))
    return rows.filter("topic_id < 4")


def narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """complaint_id, date_received, product, issue, narrative, company from documents."""
    d = _read(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("complaint_id"),
        F.date_add(F.lit(dt.date(2023, 9, 1)), (F.col("doc_id") % 213).cast("int")).alias("date_received"),
        F.col("lang").alias("product"),
        F.col("source").alias("issue"),
        F.col("text").alias("narrative"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, truth, prediction and probability (over CLASSES) by a fixed rule on documents."""
    d = _read(spark, sf_dir, "documents")
    peak = F.lit(0.4) + (F.col("doc_id") % 6).cast("double") / 10
    guess = F.when(F.col("doc_id") % 5 == 0, F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("doc_id") % 4 + 1).cast("int"))).otherwise(F.col("lang"))
    p = F.array(*[F.when(guess == c, peak).otherwise((1 - peak) / 3) for c in CLASSES])
    return d.select(F.col("doc_id").alias("row_id"), F.col("lang").alias("truth"), guess.alias("prediction"), p.alias("probability"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, vector, product from embeddings."""
    e = _read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"), F.concat(F.lit("class "), F.col("label").cast("string")).alias("product"))


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text-typed source with blanks, bad dates and repeated ids, as a file would give it."""
    d = _read(spark, sf_dir, "documents")
    i = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit(dt.date(2023, 9, 1)), (i % 213).cast("int")), "MM/dd/yyyy")
    return d.select(
        (i - F.when(i % 50 == 7, 1).otherwise(0)).cast("string").alias("complaint_id"),
        F.when(i % 41 == 3, F.lit("not a date")).otherwise(day).alias("date_text"),
        F.when(i % 29 == 5, F.lit(None)).when(i % 31 == 6, F.lit("  ")).otherwise(F.col("lang")).alias("product"),
        F.when(i % 37 == 1, F.lit(None)).otherwise(F.col("source")).alias("issue"),
        F.when(i % 4 == 1, F.lit(None)).when(i % 23 == 2, F.lit(" \t\n")).otherwise(F.concat(F.lit("  "), F.col("text"), F.lit("\n"))).alias("narrative"),
    )
