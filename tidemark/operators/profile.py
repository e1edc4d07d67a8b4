"""Profiles of a source table: schema scan, filtering funnel, duplicates, lengths, coverage, volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month, monday, week_label
from tidemark.functions.text import is_blank, stripped, text_hash, word_count

QUANTILES = (0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def null_counts(df: DataFrame) -> DataFrame:
    """column_name, null_count for each column: one scan."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in df.columns])
    return row.select(F.inline(pairs))


def schema_scan(df: DataFrame, id_col: str, day: Column, text_col: str, label_col: str, sub_label_col: str) -> DataFrame:
    """One row: rows, distinct and duplicate ids, unparsable dates, first and last date, blank texts, distinct labels."""
    known = F.col(id_col).isNotNull()
    return df.withColumn("__day", day).agg(
        F.count("*").alias("source_rows"),
        F.countDistinct(id_col).alias("distinct_ids"),
        (F.count_if(known) - F.countDistinct(id_col)).alias("duplicate_ids"),
        F.count_if(F.col("__day").isNull()).alias("invalid_dates"),
        F.min("__day").alias("minimum_date"),
        F.max("__day").alias("maximum_date"),
        F.count_if(is_blank(F.col(text_col))).alias("blank_texts"),
        F.countDistinct(label_col).alias("distinct_labels"),
        F.countDistinct(sub_label_col).alias("distinct_sub_labels"),
    )


def label_counts(df: DataFrame, label_col: str) -> DataFrame:
    """label, rows of each value that isn't null."""
    return df.filter(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("rows"))


def top_labels(df: DataFrame, label_col: str, most: int = 20) -> DataFrame:
    """The most frequent labels, ties by label."""
    return label_counts(df, label_col).orderBy(F.desc("rows"), "label").limit(most)


def funnel(df: DataFrame, text_col: str) -> DataFrame:
    """source_rows, rows_without_text, rows_kept, retention_pct."""
    blank = F.count_if(is_blank(F.col(text_col)))
    return df.agg(
        F.count("*").alias("source_rows"),
        blank.alias("rows_without_text"),
        (F.count("*") - blank).alias("rows_kept"),
        F.coalesce(F.round(F.try_divide(100.0 * (F.count("*") - blank), F.count("*")), 2), F.lit(0.0)).alias("retention_pct"),
    )


def quality_counts(df: DataFrame, day: Column, label_col: str, sub_label_col: str) -> DataFrame:
    return df.agg(
        F.count_if(day.isNull()).alias("invalid_dates"),
        F.count_if(is_blank(F.col(label_col))).alias("blank_labels"),
        F.count_if(is_blank(F.col(sub_label_col))).alias("blank_sub_labels"),
    )


def duplicate_stats(df: DataFrame, text_col: str) -> DataFrame:
    """distinct_hashes, repeated_hashes, rows_in_groups, redundant_rows of the trimmed texts."""
    groups = df.groupBy(text_hash(F.col(text_col)).alias("h")).agg(F.count("*").alias("n"))
    repeated = F.col("n") > 1
    return groups.agg(
        F.count("*").alias("distinct_hashes"),
        F.count_if(repeated).alias("repeated_hashes"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("redundant_rows"),
    )


def length_quantiles(df: DataFrame, text_col: str, points: tuple[float, ...] = QUANTILES) -> DataFrame:
    """quantile, characters, words: exact, with linear interpolation."""
    own = stripped(F.col(text_col))
    at = F.array(*map(F.lit, points))
    row = df.select(F.char_length(own).alias("c"), word_count(F.col(text_col)).alias("w")).agg(F.percentile("c", at).alias("c"), F.percentile("w", at).alias("w"))
    pairs = F.arrays_zip(at.alias("q"), "c", "w")
    return row.select(F.inline(pairs)).select(F.col("q").alias("quantile"), F.round("c", 2).alias("characters"), F.round("w", 2).alias("words"))


def coverage(df: DataFrame, label_col: str, text_col: str) -> DataFrame:
    """label, total, with_text, rate_pct: one conditional aggregate."""
    filled = F.count_if(~is_blank(F.col(text_col)))
    return (
        df.filter(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).alias("label"))
        .agg(F.count("*").alias("total"), filled.alias("with_text"), F.round(100.0 * filled / F.count("*"), 2).alias("rate_pct"))
    )


def weekly_volume(df: DataFrame, day_col: str, text_col: str) -> DataFrame:
    """week, week_start, total, with_text of every week that has a row with a date."""
    rows = df.filter(F.col(day_col).isNotNull())
    return rows.groupBy(week_label(F.col(day_col)).alias("week"), monday(F.col(day_col)).alias("week_start")).agg(F.count("*").alias("total"), F.count_if(~is_blank(F.col(text_col))).alias("with_text"))


def monthly_volume(df: DataFrame, day_col: str, text_col: str) -> DataFrame:
    """month, with_text: texts of each month."""
    rows = df.filter(F.col(day_col).isNotNull() & ~is_blank(F.col(text_col)))
    return rows.groupBy(month(F.col(day_col)).alias("month")).agg(F.count("*").alias("with_text"))
