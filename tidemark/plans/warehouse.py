"""A small star schema over monitoring results: tables, views, reconciliation, validation, exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import monday
from tidemark.functions.text import joined_terms
from tidemark.operators.guards import forbid_text_columns

DETAIL = ["complaint_id", "date_received", "product", "issue", "company", "state", "submitted_via", "topic_id"]
FACTS = ("fact_complaint_topic", "fact_weekly_topic_metric", "fact_risk_alert", "dim_topic", "fact_model_summary", "fact_model_class_metric")
#: Rows of a class report that aren't classes.
SUMMARY_KEYS = ("accuracy", "macro avg", "weighted avg")


def topic_dimension(topics: DataFrame) -> DataFrame:
    """topic_id, top_terms (joined), historical_rows and the dominant product of each topic."""
    return topics.select(
        F.col("topic_id").cast("int").alias("topic_id"), joined_terms(F.col("top_terms"), 1_000).alias("top_terms"), F.col("historical_rows").cast("long").alias("historical_rows"), "dominant_product", "dominant_product_share", F.col("product_count").cast("long").alias("product_count")
    )


def class_metrics(report: DataFrame) -> DataFrame:
    """product, precision, recall, f1_score, support without the report's summary rows."""
    return report.filter(~F.col("product").isin(*SUMMARY_KEYS)).select("product", "precision", "recall", "f1_score", F.col("support").cast("long").alias("support"))


def model_summary(test: DataFrame, majority: DataFrame, calibration: DataFrame, name: str = "tfidf_logistic_regression", scope: str = "held-out test window") -> DataFrame:
    """model_name, the four test metrics, two of the majority reference, three of calibration, evaluation_scope; of one row each."""
    left = test.select(F.lit(name).alias("model_name"), "accuracy", "balanced_accuracy", "macro_f1", "weighted_f1")
    middle = majority.select(F.col("accuracy").alias("majority_accuracy"), F.col("macro_f1").alias("majority_macro_f1"))
    right = calibration.select("expected_calibration_error", "multiclass_log_loss", "multiclass_brier_score", F.lit(scope).alias("evaluation_scope"))
    return left.crossJoin(F.broadcast(middle)).crossJoin(F.broadcast(right))


def complaint_detail(facts: DataFrame) -> DataFrame:
    names = [c for c in DETAIL if c in facts.columns]
    return facts.select(*names[:2], monday(F.col("date_received")).alias("week_start"), *names[2:])


def weekly_dashboard(weekly: DataFrame, topics: DataFrame) -> DataFrame:
    t = topics.select("topic_id", "top_terms", "dominant_product")
    return weekly.join(F.broadcast(t), "topic_id").select(
        "week_start", "topic_id", "top_terms", "dominant_product", "topic_count", "total_complaints", "topic_share", "baseline_share_median", "share_increase", "robust_z_score", "candidate_signal", "persistent_signal_count", "alert", "severity"
    )


def alert_dashboard(alerts: DataFrame, topics: DataFrame) -> DataFrame:
    return weekly_dashboard(alerts, topics).drop("candidate_signal", "alert")


def product_topic_summary(facts: DataFrame) -> DataFrame:
    """product, topic_id, complaint_count, share_within_product."""
    per = facts.groupBy("product", "topic_id").agg(F.count("*").alias("complaint_count"))
    return per.withColumn("share_within_product", F.round(F.col("complaint_count") / F.sum("complaint_count").over(Window.partitionBy("product")), 6))


def weekly_overview(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("week_start").agg(
        F.max("total_complaints").alias("narrative_complaints"),
        F.count_if("alert").alias("alert_count"),
        F.count_if("candidate_signal").alias("candidate_count"),
        F.countDistinct("topic_id").alias("monitored_topics"),
        F.max("robust_z_score").alias("maximum_robust_z_score"),
    )


def reconciliation(weekly: DataFrame, facts: DataFrame, start, end) -> DataFrame:
    """week_start, topic_id, monitoring_count, assignment_count, count_difference, anchored on the weekly table."""
    own = facts.filter(F.col("date_received").between(F.lit(start), F.lit(end))).groupBy(monday(F.col("date_received")).alias("week_start"), "topic_id").agg(F.count("*").alias("n"))
    rows = weekly.select("week_start", "topic_id", F.col("topic_count").alias("monitoring_count")).join(own, ["week_start", "topic_id"], "left")
    held = F.coalesce("n", F.lit(0)).cast("long")
    return rows.select("week_start", "topic_id", "monitoring_count", held.alias("assignment_count"), (F.col("monitoring_count") - held).alias("count_difference"))


def checks(facts: DataFrame, weekly: DataFrame, alerts: DataFrame, start, end) -> DataFrame:
    """One row with the figures that validate() judges."""
    a = facts.agg(F.count("*").alias("complaint_rows"), F.countDistinct("complaint_id").alias("unique_complaint_ids"))
    shares = weekly.groupBy("week_start").agg(F.sum("topic_share").alias("s")).agg(F.max(F.abs(F.col("s") - 1)).alias("maximum_weekly_share_sum_error"))
    w = weekly.agg(F.count("*").alias("weekly_topic_rows"), F.count_if("alert").alias("weekly_alert_flag_rows"))
    r = alerts.agg(F.count("*").alias("alert_rows"))
    d = reconciliation(weekly, facts, start, end).agg(F.coalesce(F.sum(F.abs("count_difference")), F.lit(0)).alias("assignment_monitoring_count_difference"))
    return a.crossJoin(w).crossJoin(r).crossJoin(shares).crossJoin(d)  # one row each


def validate(facts: DataFrame, weekly: DataFrame, alerts: DataFrame, start, end) -> dict:
    """The checks, or an error that names every rule that fails."""
    row = checks(facts, weekly, alerts, start, end).first().asDict()
    failures = []
    if row["complaint_rows"] != row["unique_complaint_ids"]:
        failures.append("complaint ids are not unique")
    if row["alert_rows"] != row["weekly_alert_flag_rows"]:
        failures.append("alert rows differ from the weekly alert flags")
    if (row["maximum_weekly_share_sum_error"] or 0.0) > 1e-8:
        failures.append("weekly shares do not sum to one")
    if row["assignment_monitoring_count_difference"] != 0:
        failures.append("weekly counts differ from the assignments")
    if failures:
        raise ValueError("; ".join(failures))
    return row


def publish(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """Registers the tables and all views over them; text columns are refused. Returns the view names."""
    for name, df in tables.items():
        forbid_text_columns(df, name).createOrReplaceTempView(name)
    t = {name: spark.table(name) for name in tables}
    views = {
        "vw_complaint_detail": complaint_detail(t["fact_complaint_topic"]),
        "vw_topic_catalog": t["dim_topic"],
        "vw_weekly_topic_dashboard": weekly_dashboard(t["fact_weekly_topic_metric"], t["dim_topic"]),
        "vw_alert_dashboard": alert_dashboard(t["fact_risk_alert"], t["dim_topic"]),
        "vw_product_topic_summary": product_topic_summary(t["fact_complaint_topic"]),
        "vw_weekly_overview": weekly_overview(t["fact_weekly_topic_metric"]),
    }
    views |= {v: t[f] for v, f in (("vw_model_summary", "fact_model_summary"), ("vw_model_class_performance", "fact_model_class_metric")) if f in t}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def bi_measures(facts: DataFrame, weekly: DataFrame, alerts: DataFrame) -> DataFrame:
    """The report's six measures in one row."""
    a = facts.agg(F.countDistinct("complaint_id").alias("complaints"))
    o = weekly_overview(weekly).agg(F.sum("narrative_complaints").alias("monitored_complaints"))
    r = alerts.agg(F.count("*").alias("alerts"), F.countDistinct("topic_id").alias("alerted_topics"))
    w = weekly.agg(F.round(F.avg("topic_share"), 9).alias("average_topic_share"), F.round(F.max("robust_z_score"), 9).alias("maximum_robust_z_score"))
    return a.crossJoin(o).crossJoin(r).crossJoin(w)  # one row each


def drillthrough(facts: DataFrame, topic_id, week_start) -> DataFrame:
    """The complaints behind one selected alert: its topic and its week."""
    return complaint_detail(facts).filter((F.col("topic_id") == F.lit(topic_id)) & (F.col("week_start") == F.lit(week_start)))


def counts_by(facts: DataFrame, column: str) -> DataFrame:
    """value, complaints of a report visual."""
    return facts.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("complaints"))
