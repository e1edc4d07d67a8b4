import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import parsed_date
from tidemark.functions.text import grams, stripped, word_count
from tidemark.operators import guards, profile, splits
from tidemark.plans.adapters import WINDOWS


def test_trim_and_words_cover_unicode_space(spark):
    df = spark.createDataFrame([("\u00a0 a\u2003b c\t\n",), (None,), ("  ",)], "t string")
    got = df.select(stripped(F.col("t")), word_count(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("a\u2003b c", 3), ("", 0), ("", 0)]


def test_dates_are_permissive(spark):
    df = spark.createDataFrame([("09/08/2023",), ("2023-09-01",), ("soon",), (None,)], "t string")
    assert [r[0] for r in df.select(parsed_date(F.col("t"))).collect()] == [dt.date(2023, 9, 8), dt.date(2023, 9, 1), None, None]


def test_grams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), ([],)], "w array<string>")
    assert [r[0] for r in df.select(grams(F.col("w"))).collect()] == [["a", "b", "c", "a b", "b c"], []]


def test_schema_scan_and_funnel(spark):
    rows = [("1", "09/01/2023", "p", "i", "x"), ("2", "09/08/2023", "q", "i", "y"), ("3", "bad", "p", "j", "  ")]
    df = spark.createDataFrame(rows, "id string, d string, product string, issue string, narrative string")
    got = profile.schema_scan(df, "id", parsed_date(F.col("d")), "narrative", "product", "issue").first()
    assert (got.source_rows, got.invalid_dates, got.blank_texts, got.distinct_labels, got.duplicate_ids) == (3, 1, 1, 2, 0)
    assert str(got.minimum_date) == "2023-09-01" and str(got.maximum_date) == "2023-09-08"
    assert tuple(profile.funnel(df, "narrative").first()) == (3, 1, 2, 66.67)
    assert tuple(profile.funnel(df.limit(0), "narrative").first()) == (0, 0, 0, 0.0)


def test_duplicates_and_coverage(spark):
    df = spark.createDataFrame([("a", " x "), ("a", "x"), ("b", None), (None, "z")], "product string, t string")
    assert tuple(profile.duplicate_stats(df.filter("t is not null"), "t").first()) == (2, 1, 2, 1)
    assert {r.label: (r.total, r.with_text, r.rate_pct) for r in profile.coverage(df, "product", "t").collect()} == {"a": (2, 2, 100.0), "b": (1, 0, 0.0)}


def test_splits_drop_repeats_conflicts_and_earlier_texts(spark):
    rows = [
        (1, "2023-09-01", "a", "one"), (2, "2023-09-02", "a", " one "), (3, "2023-09-03", "a", "two"), (4, "2023-09-04", "b", "two"),
        (5, "2024-01-01", "a", "one"), (6, "2024-01-02", "b", "two"), (7, "2024-01-03", "b", "two"), (8, "2024-03-01", "c", "three"), (9, "2024-03-02", "b", "two"), (10, None, "a", "four"), (11, "2025-01-01", "a", "five"),
    ]
    df = spark.createDataFrame(rows, "complaint_id long, d string, product string, narrative string").withColumn("date_received", F.col("d").cast("date"))
    good = splits.usable(df, "complaint_id", "date_received", "product", "narrative")
    stages = splits.staged(good, WINDOWS, "complaint_id", "date_received", "product")
    got = {n: sorted(r.complaint_id for r in splits.kept(stages, n).collect()) for n in WINDOWS}
    # a text that conflicted in training may come back in validation
    assert got == {"train": [1], "validation": [6], "test": [8]}
    stats = {r.split: r for r in splits.statistics(stages).collect()}
    assert (stats["train"].removed_conflicting, stats["train"].conflicting_hashes, stats["train"].removed_repeats) == (2, 1, 1)
    assert stats["validation"].removed_seen_earlier == 1 and stats["test"].removed_seen_earlier == 1
    assert tuple(splits.outside(good, df, WINDOWS, "date_received").first()) == (1, 1)
    splits.require_disjoint(stages)


def test_windows_must_be_ordered_and_disjoint():
    base = {"train_start": "2023-09-01", "train_end": "2023-12-31", "validation_start": "2023-12-31", "validation_end": "2024-02-29", "test_start": "2024-03-01", "test_end": "2024-03-31"}
    with pytest.raises(ValueError, match="overlaps"):
        guards.split_windows(base)
    assert guards.split_windows(base | {"validation_start": "2024-01-01"})["test"][1] == dt.date(2024, 3, 31)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="nothing"):
        guards.require_columns(spark.range(1), ["id", "nothing"])


def test_outer_space_is_that_of_the_regular_expression(spark):
    """Trimmed by a list of characters: a search for runs of white space visits every run of a text."""
    rows = [(chr(c) + "a \n b" + chr(c) * 2 + "\n",) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [("",), (" \t",)]
    df = spark.createDataFrame(rows, "t string").coalesce(1)
    assert df.filter(stripped(F.col("t")) != F.regexp_replace("t", r"(?U)^\s+|\s+$", "")).count() == 0
    assert "regexp" not in df.select(stripped(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
