"""The ten batch stages: each reads what earlier stages published and publishes its own outputs.

A stage takes a session and a configuration mapping (the sections and keys of
its YAML file) and returns its report.  Tables are Parquet folders unless the
configured path ends in .csv; reports are JSON.  Outputs that exist are an
error without ``overwrite``, checked before any work.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import iso, parsed_date
from tidemark.functions.text import TOPIC_TOKEN, stripped
from tidemark.operators import metrics, models, profile, retrieval, splits, topics, weekly
from tidemark.operators.guards import day, forbid_text_columns, require, require_columns, split_windows
from tidemark.plans import warehouse as wh
from tidemark.sinks.files import export_views, save_tables, write_csv, write_json
from tidemark.sources import archives, files

#: Source columns and what they are called afterwards.
RENAMED = {
    "Complaint ID": "complaint_id",
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "narrative",
    "Company": "company",
    "State": "state",
    "Submitted via": "submitted_via",
}


def _now() -> str:
    return datetime.now(UTC).isoformat()


def _guard(overwrite: bool, *paths: str) -> None:
    for p in paths:
        if Path(p).exists() and not overwrite:
            raise FileExistsError(p)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return files.read_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def _write(df: DataFrame, path: str) -> None:
    if path.endswith(".csv"):
        write_csv(df, path, True)
    else:
        df.write.mode("overwrite").parquet(path)


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(True) for r in df.collect()]


def _figures(spark: SparkSession, row: dict) -> DataFrame:
    """One row of numbers, any of which may be missing."""
    return spark.createDataFrame([tuple(None if v is None else float(v) for v in row.values())], ", ".join(f"{k} double" for k in row))


def acquisition(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    s, at, d = config["source"], config["local"], config["download"]
    _guard(overwrite, at["archive_path"], at["metadata_path"])
    about = {k: s[k] for k in ("authority", "archive_page", "archive_period") if k in s}
    return archives.acquire(s["archive_url"], at["archive_path"], at["metadata_path"], s["expected_compressed_bytes"], timeout=d["timeout_seconds"], chunk_bytes=d["chunk_bytes"], multiplier=d["minimum_free_space_multiplier"], overwrite=overwrite, about=about)


def inspection(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    at, x = config["local"], config["extraction"]
    _guard(overwrite, at["extracted_path"], at["extraction_metadata_path"], at["schema_report_path"])
    archives.verify_archive(at["archive_path"], archives.load_metadata(at["metadata_path"]))
    got = archives.extract_member(at["archive_path"], x["member_name"], at["extracted_path"], overwrite)
    write_json(got, at["extraction_metadata_path"], overwrite)
    form = files.text_format(at["extracted_path"], x["encoding"], x["delimiter"])
    require(not set(x["required_columns"]) - set(form["header"]), "the source lacks required columns")
    df = files.read_csv(spark, at["extracted_path"], delimiter=x["delimiter"])
    scan = profile.schema_scan(df, "Complaint ID", parsed_date(F.col("Date received")), "Consumer complaint narrative", "Product", "Issue")
    report = {"format": form, "scan": _rows(scan)[0], "null_counts": _rows(profile.null_counts(df)), "top_products": _rows(profile.top_labels(df, "Product")), "top_issues": _rows(profile.top_labels(df, "Issue")), "generated_at": _now()}
    write_json(report, at["schema_report_path"], overwrite)
    return report


def prepared(source: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with text, renamed, trimmed, dates as ISO text (null where unparsable)."""
    unknown = sorted(set(columns) - set(RENAMED.values()))
    require(not unknown, f"unknown output columns: {', '.join(unknown)}")
    df = source.select(*[F.col(f"`{a}`").alias(b) for a, b in RENAMED.items() if a in source.columns])
    df = df.withColumns({"narrative": stripped(F.col("narrative")), "date_received": iso(parsed_date(F.col("date_received")))})
    return df.filter(F.col("narrative") != "").select(*columns)


def preparation(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    at, p = config["local"], config["preparation"]
    _guard(overwrite, at["narrative_dataset_path"], at["eda_report_path"])
    source = files.read_csv(spark, at["extracted_path"])
    require_columns(source, [a for a, b in RENAMED.items() if b in p["output_columns"]], "source")
    out = prepared(source, p["output_columns"])
    _write(out, at["narrative_dataset_path"])
    kept = _read(spark, at["narrative_dataset_path"])
    dated = source.withColumn("day", parsed_date(F.col("Date received")))
    text = "Consumer complaint narrative"
    report = {
        "generated_at": _now(),
        "funnel": _rows(profile.funnel(source, text))[0],
        "quality": _rows(profile.quality_counts(source, parsed_date(F.col("Date received")), "Product", "Issue"))[0],
        "duplicates": _rows(profile.duplicate_stats(kept, "narrative"))[0],
        "lengths": _rows(profile.length_quantiles(kept, "narrative")),
        "product_coverage": _rows(profile.coverage(source, "Product", text).orderBy(F.desc("total"), "label")),
        "issue_coverage": _rows(profile.coverage(source, "Issue", text).orderBy(F.desc("total"), "label")),
        "weekly_volume": _rows(profile.weekly_volume(dated, "day", text).orderBy("week")),
        "monthly_volume": _rows(profile.monthly_volume(dated, "day", text).orderBy("month")),
    }
    write_json(report, at["eda_report_path"], overwrite)
    return report


def splitting(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    c, windows = config["data"], split_windows(config["split"])
    _guard(overwrite, *(c[f"{n}_path"] for n in windows), c["split_report_path"])
    source = _read(spark, c["prepared_path"])
    source = source.withColumn(c["date_column"], parsed_date(F.col(c["date_column"])))
    good = splits.usable(source, c["id_column"], c["date_column"], c["target_column"], c["text_column"])
    stages = splits.staged(good, windows, c["id_column"], c["date_column"], c["target_column"]).cache()
    splits.require_disjoint(stages)
    for name in windows:
        _write(splits.kept(stages, name), c[f"{name}_path"])
    outputs = {n: {"path": c[f"{n}_path"], "sha256": files.folder_digest(spark, c[f"{n}_path"])} for n in windows}
    report = {"generated_at": _now(), "outputs": outputs, "splits": _rows(splits.statistics(stages)), "labels": _rows(splits.label_distribution(stages, c["target_column"])), **_rows(splits.outside(good, source, windows, c["date_column"]))[0]}
    stages.unpersist()
    write_json(report, c["split_report_path"], overwrite)
    return report


def _fit_limits(m: dict) -> dict:
    return {"min_df": m["min_document_frequency"], "max_features": m["max_features"], "ngram_max": m["ngram_max"]}


def baseline(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    c, m = config["data"], config["model"]
    _guard(overwrite, m["artifact_path"], m["metrics_path"])
    part = [files.load_split(_read(spark, c[f"{n}_path"]), c["text_column"], c["target_column"]) for n in ("train", "validation", "test")]
    got = models.train(*part, text_col=c["text_column"], label_col=c["target_column"], candidates=[x["c"] for x in m["candidates"]], max_iterations=m["max_iterations"], **_fit_limits(m))
    models.save_text_model(spark, got["features"], got["model"], m["artifact_path"], overwrite)
    predictions = got["predictions"].cache()
    matrix = metrics.confusion(predictions)
    both = part[0].unionByName(part[1], allowMissingColumns=True).select(F.col(c["target_column"]).alias("truth"))
    report = {
        "generated_at": _now(),
        "candidates": got["candidates"],
        "chosen_c": got["chosen"],
        "classes": got["classes"],
        "test_metrics": _rows(metrics.summary(matrix))[0],
        "per_class": _rows(metrics.per_class(matrix).orderBy("label")),
        "confusion": _rows(matrix.orderBy("actual", "predicted")),
        "test_majority_baseline": _rows(metrics.summary(metrics.confusion(metrics.majority_predictions(both, predictions))))[0],
    }
    predictions.unpersist()
    write_json(report, m["metrics_path"], overwrite)
    return report


def evaluation(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    """Runs the saved model over the test split; nothing is fitted."""
    c, m = config["data"], config["model"]
    _guard(overwrite, m["evaluation_report_path"])
    features, model = models.load_text_model(spark, m["artifact_path"])
    classes = models.classes_of(model)
    test = files.load_split(_read(spark, c["test_path"]), c["text_column"], c["target_column"])
    rows = models.predict(model, features.transform(test, c["text_column"]), c["target_column"]).cache()
    matrix = metrics.confusion(rows)
    frozen = {"model_sha256": files.folder_digest(spark, m["artifact_path"]), "test_sha256": files.folder_digest(spark, c["test_path"]), "test_rows": rows.count(), "test_metrics": _rows(metrics.summary(matrix))[0]}
    report = {"generated_at": _now(), **frozen, "calibration": _rows(metrics.calibration_summary(rows, classes))[0], "bins": _rows(metrics.calibration_bins(rows, classes).orderBy("bin")), "top_confusions": _rows(metrics.top_confusions(matrix))}
    rows.unpersist()
    write_json(report, m["evaluation_report_path"], overwrite)
    return report


def retrieval_stage(spark: SparkSession, config: dict, overwrite: bool = False, query: str | None = None, k: int | None = None) -> dict | list[dict]:
    """Builds and evaluates the index, or, given a query, searches the saved one (k of 0 or none means the configured k)."""
    c, r = config["data"], config["retrieval"]
    fit = {"ngram_max": r.get("ngram_max", 2)}
    if query is not None:
        meta, terms, corpus = (spark.read.parquet(f"{r['index_path']}/{n}") for n in ("metadata", "terms", "weights"))
        return _rows(retrieval.search(terms, corpus, meta, query, k or r["k"], **fit).orderBy("rank"))
    _guard(overwrite, r["index_path"], r["report_path"])
    part = {n: _read(spark, c[f"{n}_path"]) for n in ("train", "validation", "test")}
    docs = part["train"].unionByName(part["validation"], allowMissingColumns=True)
    keep = [x for x in (c["date_column"], c["target_column"], c["hash_column"]) if x in docs.columns]
    for name, df in zip(("metadata", "terms", "weights"), retrieval.index(docs, c["id_column"], c["text_column"], keep, c["hash_column"], min_df=r.get("min_df", 3), max_features=r.get("max_features", 50_000), **fit)):
        df.write.mode("overwrite").parquet(f"{r['index_path']}/{name}")
    meta, terms, corpus = (spark.read.parquet(f"{r['index_path']}/{n}") for n in ("metadata", "terms", "weights"))
    retrieval.require_no_overlap(part["test"], meta, c["hash_column"])
    sample = retrieval.sampled_queries(part["test"], c["id_column"], c["target_column"], r["queries_per_class"], r.get("random_seed", 42)).withColumnRenamed(c["id_column"], "doc_id")
    found = retrieval.by_terms(retrieval.weights(retrieval.term_counts(sample, "doc_id", c["text_column"], **fit), terms), corpus)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id"))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= r["k"])
    rows = retrieval.judged(ranked, sample, meta, c["target_column"]).cache()
    report = {"generated_at": _now(), "k": r["k"], **_rows(retrieval.summary(rows, meta, c["target_column"]))[0], "per_class": _rows(retrieval.by_class(rows).orderBy("label")), "index_rows": meta.count(), "non_zeros": corpus.count()}
    rows.unpersist()
    write_json(report, r["report_path"], overwrite)
    return report


def clustering(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    c, k = config["data"], config["clustering"]
    _guard(overwrite, k["model_path"], k["report_path"], c["assignments_path"])
    docs = _read(spark, c["train_path"]).unionByName(_read(spark, c["validation_path"]), allowMissingColumns=True)
    stop = (StopWordsRemover.loadDefaultStopWords("english") if k.get("use_english_stop_words") else []) + list(k.get("excluded_tokens", []))
    f = models.fit_features(docs, c["text_column"], min_df=k["min_document_frequency"], max_df=k["max_document_frequency"], max_features=k["max_features"], ngram_max=k["ngram_max"], pattern=TOPIC_TOKEN, stop=stop)
    rows = f.transform(docs, c["text_column"])
    model, tried = topics.fit_candidates(rows, k["candidate_clusters"], max_iterations=k["max_iterations"], n_init=k["n_init"], sample_size=k["evaluation_sample_size"], minimum_fraction=k["minimum_cluster_fraction"], seed=config.get("project", {}).get("random_seed", 42))
    models.save_text_model(spark, f, PipelineModel(stages=[model]), k["model_path"], overwrite)
    n = model.getK()
    described = topics.describe(model.transform(rows), n, "product").join(topics.top_terms(model, f.vocabulary, spark, k["top_terms_per_cluster"]), "topic_id")
    source = _read(spark, c["prepared_path"])
    assigned = topics.assign(model, f.transform(source, c["text_column"]), [x for x in c["retained_columns"] if x in source.columns])
    _write(forbid_text_columns(assigned, "assignments"), c["assignments_path"])
    report = {"generated_at": _now(), "candidates": [vars(t) for t in tried], "selected_clusters": n, "topics": _rows(described.orderBy("topic_id")), "assignment_counts": _rows(topics.cluster_sizes(_read(spark, c["assignments_path"]), n).orderBy("topic_id"))}
    write_json(report, k["report_path"], overwrite)
    return report


def _topics(spark: SparkSession, path: str) -> DataFrame:
    said = files.read_json(path)["topics"]
    return spark.createDataFrame([(t["topic_id"], t["top_terms"], t["historical_rows"], t["dominant_product"], t["dominant_product_share"], t["product_count"]) for t in said], "topic_id int, top_terms array<string>, historical_rows long, dominant_product string, dominant_product_share double, product_count long")


def risk_detection(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    c, r = config["data"], config["risk_detection"]
    _guard(overwrite, c["weekly_metrics_path"], c["alerts_path"], c["report_path"])
    rules = weekly.ScoreRules(**{k: r[k] for k in weekly.ScoreRules.__dataclass_fields__ if k in r})
    assigned = _read(spark, c["assignments_path"]).select(parsed_date(F.col("date_received").cast("string")).alias("date_received"), F.col("topic_id").cast("int").alias("topic_id"))
    scores = weekly.scored(weekly.grid(assigned, day(r["analysis_start"]), day(r["analysis_end"])), rules)
    _write(weekly.with_terms(scores, _topics(spark, c["clustering_report_path"])), c["weekly_metrics_path"])
    scores = typed_weekly(spark, c["weekly_metrics_path"])
    _write(weekly.alerts(scores), c["alerts_path"])
    report = {"generated_at": _now(), "coverage": _rows(weekly.coverage(scores))[0], "top_alerts": _rows(weekly.top_alerts(scores))}
    write_json(report, c["report_path"], overwrite)
    return report


WEEKLY = "topic_id int, week_start date, topic_count long, total_complaints long, topic_share double, history_weeks long, baseline_share_median double, baseline_share_scale double, baseline_count_mean double, share_increase double, robust_z_score double, candidate_signal boolean, persistent_signal_count long, alert boolean, severity string, topic_terms string"


def typed_weekly(spark: SparkSession, path: str) -> DataFrame:
    """The weekly table with its contract's types, whatever it was stored as."""
    df = _read(spark, path)
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in (x.strip().split(" ") for x in WEEKLY.split(","))])


def analytics(spark: SparkSession, config: dict, overwrite: bool = False) -> dict:
    c, a = config["data"], config["analytics"]
    _guard(overwrite, a["export_directory"], a["report_path"])
    base, judged = files.read_json(c["baseline_metrics_path"]), files.read_json(c["evaluation_report_path"])
    facts = _read(spark, c["topic_assignments_path"]).withColumns({"date_received": parsed_date(F.col("date_received").cast("string")), "topic_id": F.col("topic_id").cast("int")})
    summary = wh.model_summary(*(_figures(spark, x) for x in (base["test_metrics"], base["test_majority_baseline"], judged["calibration"])))
    classes = spark.createDataFrame([(x["label"], x["precision"], x["recall"], x["f1"], x["support"]) for x in base["per_class"]], "product string, precision double, recall double, f1_score double, support long")
    scores, alerts = typed_weekly(spark, c["weekly_metrics_path"]), typed_weekly(spark, c["alerts_path"])
    tables = {"fact_complaint_topic": facts, "fact_weekly_topic_metric": scores, "fact_risk_alert": alerts, "dim_topic": wh.topic_dimension(_topics(spark, c["clustering_report_path"])), "fact_model_summary": summary, "fact_model_class_metric": wh.class_metrics(classes)}
    if a.get("database"):
        save_tables(tables, a["database"])
    wh.publish(spark, tables)
    window = scores.agg(F.min("week_start"), F.date_add(F.max("week_start"), 6)).first()
    checks = wh.validate(facts, scores, alerts, *window)
    report = {"generated_at": _now(), "checks": checks, "exports": export_views(spark, a["exports"], a["export_directory"], overwrite)}
    write_json(report, a["report_path"], overwrite)
    return report


STAGES = {
    "acquisition": (acquisition, "configs/dataset.yaml"),
    "inspection": (inspection, "configs/dataset.yaml"),
    "preparation": (preparation, "configs/dataset.yaml"),
    "splitting": (splitting, "configs/baseline.yaml"),
    "baseline": (baseline, "configs/baseline.yaml"),
    "evaluation": (evaluation, "configs/baseline.yaml"),
    "retrieval": (retrieval_stage, "configs/retrieval.yaml"),
    "clustering": (clustering, "configs/clustering.yaml"),
    "risk_detection": (risk_detection, "configs/risk_detection.yaml"),
    "analytics": (analytics, "configs/analytics.yaml"),
}


def shown(report) -> str:
    return json.dumps(report, indent=2, default=str)


__all__ = ["STAGES", "prepared", "shown", "typed_weekly"]
