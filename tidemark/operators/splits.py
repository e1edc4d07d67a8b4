"""Chronological splits without leakage between them.

In window order, a split drops rows whose text was kept by an earlier split,
then rows of texts with several labels within what remains, then all but the
first row of each text.  Only kept texts count as seen: a text dropped for its
labels may come back in a later window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import stripped, text_hash
from tidemark.operators.guards import require_columns


def usable(df: DataFrame, id_col: str, day_col: str, label_col: str, text_col: str) -> DataFrame:
    """Rows with text, label and date, the first two trimmed, with narrative_hash."""
    require_columns(df, (id_col, day_col, label_col, text_col), "split source")
    rows = df.withColumns({text_col: stripped(F.col(text_col)), label_col: stripped(F.col(label_col))})
    fit = (F.col(text_col) != "") & (F.col(label_col) != "") & F.col(day_col).isNotNull()
    return rows.filter(fit).withColumn("narrative_hash", text_hash(F.col(text_col)))


def staged(rows: DataFrame, windows: dict[str, tuple[dt.date, dt.date]], id_col: str, day_col: str, label_col: str) -> DataFrame:
    """Every row of the windows with split and state: kept, seen_earlier, conflicting or repeated.

    All windows are decided at once: partial aggregates give a row for each text
    and window (its labels and its first row), a window function over those few
    rows finds the split that keeps the text, and a join brings the verdict back.
    No join against a growing set of seen hashes is needed, and a text that
    repeats without end is summed up before it is shuffled.
    """
    name = F.coalesce(*[F.when(F.col(day_col).between(F.lit(a), F.lit(b)), F.lit(s)) for s, (a, b) in windows.items()])
    inside = rows.withColumn("split", name).filter("split is not null")
    number = F.coalesce(*[F.when(F.col("split") == s, F.lit(i)) for i, s in enumerate(windows)])
    texts = inside.groupBy("narrative_hash", "split").agg(
        (F.min(label_col) != F.max(label_col)).alias("__mixed"),
        F.min(F.struct(F.col(day_col).alias("d"), F.col(id_col).alias("i"))).alias("__first"),
    )
    texts = texts.withColumn("__n", number)
    texts = texts.withColumn("__keeps", F.min(F.when(~F.col("__mixed"), F.col("__n"))).over(Window.partitionBy("narrative_hash")))
    joined = inside.join(texts, ["narrative_hash", "split"])
    state = (
        F.when(F.col("__n") > F.col("__keeps"), "seen_earlier")
        .when(F.col("__mixed"), "conflicting")
        .when((F.col(day_col) != F.col("__first.d")) | (F.col(id_col) != F.col("__first.i")), "repeated")
        .otherwise("kept")
    )
    return joined.withColumn("state", state).drop("__mixed", "__first", "__n", "__keeps")


def kept(stages: DataFrame, split: str | None = None) -> DataFrame:
    out = stages.filter("state = 'kept'")
    return (out if split is None else out.filter(F.col("split") == split)).drop("state")


def statistics(stages: DataFrame) -> DataFrame:
    """split, window_rows, removed_seen_earlier, conflicting_hashes, removed_conflicting, removed_repeats, final_rows."""
    n = lambda s: F.count_if(F.col("state") == s)
    return stages.groupBy("split").agg(
        F.count("*").alias("window_rows"),
        n("seen_earlier").alias("removed_seen_earlier"),
        F.countDistinct(F.when(F.col("state") == "conflicting", F.col("narrative_hash"))).alias("conflicting_hashes"),
        n("conflicting").alias("removed_conflicting"),
        n("repeated").alias("removed_repeats"),
        n("kept").alias("final_rows"),
    )


def label_distribution(stages: DataFrame, label_col: str) -> DataFrame:
    return kept(stages).groupBy("split", F.col(label_col).alias("label")).agg(F.count("*").alias("rows"))


def outside(rows: DataFrame, source_rows: DataFrame, windows: dict[str, tuple[dt.date, dt.date]], day_col: str) -> DataFrame:
    """invalid_rows and rows_outside_windows."""
    held = F.lit(False)
    for a, b in windows.values():
        held = held | F.col(day_col).between(F.lit(a), F.lit(b))
    good = rows.agg(F.count("*").alias("good"), F.count_if(~held).alias("rows_outside_windows"))
    return source_rows.agg(F.count("*").alias("all")).crossJoin(good).select((F.col("all") - F.col("good")).alias("invalid_rows"), "rows_outside_windows")


def overlaps(stages: DataFrame) -> DataFrame:
    """split_a, split_b, shared: texts that two splits both kept (none, if the splits are sound)."""
    own = kept(stages).select("split", "narrative_hash").distinct()
    pairs = own.alias("a").join(own.alias("b"), "narrative_hash").filter("a.split < b.split")
    return pairs.groupBy(F.col("a.split").alias("split_a"), F.col("b.split").alias("split_b")).agg(F.count("*").alias("shared"))


def require_disjoint(stages: DataFrame) -> None:
    found = overlaps(stages).collect()
    if found:
        raise RuntimeError("splits share texts: " + ", ".join(f"{r.split_a}/{r.split_b}: {r.shared}" for r in found))
