"""Weekly topic monitoring: a complete grid, robust scores against prior weeks, candidates, alerts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import monday
from tidemark.functions.text import joined_terms
from tidemark.operators.guards import require, require_columns, require_none

#: Scale of the median absolute deviation, and the score from which an alert is high.
MAD_SCALE, HIGH_SCORE = 1.4826, 7.0


@dataclass(frozen=True)
class ScoreRules:
    """Parameters of scored()."""

    lookback_weeks: int = 8
    minimum_history_weeks: int = 6
    robust_z_threshold: float = 3.5
    minimum_weekly_count: int = 100
    minimum_share_increase: float = 0.001
    scale_floor: float = 0.0005
    persistence_window_weeks: int = 3
    persistence_required_weeks: int = 2

    def __post_init__(self) -> None:
        require(self.lookback_weeks >= self.minimum_history_weeks >= 2, "lookback must be at least the minimum history, which must be at least 2")
        require(1 <= self.persistence_required_weeks <= self.persistence_window_weeks, "persistence must be required of 1 to all weeks of its window")
        require(self.scale_floor > 0, "the scale floor must be positive")


def grid(assignments: DataFrame, start: dt.date, end: dt.date, day_col: str = "date_received", topic_col: str = "topic_id") -> DataFrame:
    """topic_id, week_start, topic_count, total_complaints, topic_share: every topic seen in the window in every week.

    Weeks are the Mondays from start on; an assignment without a date is an error.
    """
    require_columns(assignments, (day_col, topic_col), "assignments")
    require(start <= end, "the window ends before it starts")
    require_none(assignments.filter(F.col(day_col).isNull()), "assignments without a valid date")
    inside = assignments.filter(F.col(day_col).between(F.lit(start), F.lit(end)))
    counts = inside.groupBy(F.col(topic_col).cast("int").alias("topic_id"), monday(F.col(day_col)).alias("week_start")).agg(F.count("*").alias("n"))
    first = start + dt.timedelta(days=-start.weekday() % 7)
    weeks = assignments.sparkSession.range(max(0, (end - first).days // 7 + 1)).select(F.date_add(F.lit(first), (F.col("id") * 7).cast("int")).alias("week_start"))
    # topics and weeks are dimensions: their product is the grid itself
    cells = counts.select("topic_id").distinct().crossJoin(F.broadcast(weeks))
    rows = cells.join(counts, ["topic_id", "week_start"], "left").select("topic_id", "week_start", F.coalesce("n", F.lit(0)).cast("long").alias("topic_count"))
    rows = rows.withColumn("total_complaints", F.sum("topic_count").over(Window.partitionBy("week_start")))
    return rows.withColumn("topic_share", F.when(F.col("total_complaints") > 0, F.col("topic_count") / F.col("total_complaints")).otherwise(F.lit(0.0)))


def scored(weekly: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """weekly with baselines, robust_z_score, candidate_signal, persistent_signal_count, alert and severity.

    The baseline of a week holds prior weeks alone; persistence counts the week itself.
    A week with too little history has null baselines and is no candidate.
    """
    frame = f"PARTITION BY topic_id ORDER BY week_start ROWS BETWEEN {rules.lookback_weeks} PRECEDING AND 1 PRECEDING"
    rows = weekly.withColumns(
        {
            "history_weeks": F.expr(f"count(*) OVER ({frame})"),
            "__median": F.expr(f"percentile(topic_share, 0.5) OVER ({frame})"),
            "__shares": F.expr(f"collect_list(topic_share) OVER ({frame})"),
            "__mean": F.expr(f"avg(topic_count) OVER ({frame})"),
        }
    )
    off = F.sort_array(F.transform("__shares", lambda x: F.abs(x - F.col("__median"))))
    n = F.size(off)
    middle = (F.element_at(off, F.floor((n + 1) / 2).cast("int")) + F.element_at(off, F.floor((n + 2) / 2).cast("int"))) / 2
    enough = F.col("history_weeks") >= rules.minimum_history_weeks
    rows = rows.withColumns(
        {
            "baseline_share_median": F.when(enough, F.col("__median")),
            "baseline_share_scale": F.when(enough, F.greatest(F.lit(MAD_SCALE) * middle, F.lit(float(rules.scale_floor)))),
            "baseline_count_mean": F.when(enough, F.col("__mean")),
        }
    ).drop("__median", "__shares", "__mean")
    rows = rows.withColumn("share_increase", F.col("topic_share") - F.col("baseline_share_median"))
    rows = rows.withColumn("robust_z_score", F.col("share_increase") / F.col("baseline_share_scale"))
    candidate = (F.col("robust_z_score") >= rules.robust_z_threshold) & (F.col("topic_count") >= rules.minimum_weekly_count) & (F.col("share_increase") >= rules.minimum_share_increase)
    rows = rows.withColumn("candidate_signal", F.coalesce(candidate, F.lit(False)))
    recent = Window.partitionBy("topic_id").orderBy("week_start").rowsBetween(1 - rules.persistence_window_weeks, 0)
    rows = rows.withColumn("persistent_signal_count", F.sum(F.col("candidate_signal").cast("long")).over(recent))
    rows = rows.withColumn("alert", F.col("candidate_signal") & (F.col("persistent_signal_count") >= rules.persistence_required_weeks))
    severity = F.when(F.col("alert") & (F.col("robust_z_score") >= HIGH_SCORE), "high").when(F.col("alert"), "review").otherwise("none")
    return rows.withColumn("severity", severity)


def with_terms(rows: DataFrame, topics: DataFrame, most: int = 5) -> DataFrame:
    """Adds topic_terms, the topic's first terms; null for topics without description. topics: topic_id, top_terms (array)."""
    terms = topics.select("topic_id", joined_terms(F.col("top_terms"), most).alias("topic_terms"))
    return rows.join(terms, "topic_id", "left")


def alerts(scores: DataFrame) -> DataFrame:
    return scores.filter("alert")


def top_alerts(scores: DataFrame, most: int = 10) -> DataFrame:
    """The alerts of greatest score, ties by week and topic."""
    names = ["topic_id", "week_start", "topic_count", "topic_share", "baseline_share_median", "share_increase", "robust_z_score", "persistent_signal_count", "severity"]
    return alerts(scores).orderBy(F.desc("robust_z_score"), "week_start", "topic_id").limit(most).select(*names)


def coverage(scores: DataFrame) -> DataFrame:
    """weeks, topics, topic_weeks, candidates, alerts, alerted_topics."""
    return scores.agg(
        F.countDistinct("week_start").alias("weeks"),
        F.countDistinct("topic_id").alias("topics"),
        F.count("*").alias("topic_weeks"),
        F.count_if("candidate_signal").alias("candidates"),
        F.count_if("alert").alias("alerts"),
        F.countDistinct(F.when(F.col("alert"), F.col("topic_id"))).alias("alerted_topics"),
    )
