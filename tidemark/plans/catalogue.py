"""Registered queries of the core engine, with their DuckDB oracles."""

from __future__ import annotations

import datetime as dt
import io
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import iso, month, monday, parsed_date
from tidemark.functions.text import TOPIC_TOKEN, stripped, text_hash, tokens, word_count
from tidemark.operators import guards, metrics, models, profile, retrieval, splits, tfidf, topics, weekly
from tidemark.plans import adapters as ad
from tidemark.plans import stages
from tidemark.plans import warehouse as wh
from tidemark.sinks.files import shared_folder, write_csv, write_json, write_single_csv
from tidemark.sources import archives, files

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _grid(s, d):
    return weekly.grid(ad.assignments(s, d), *ad.MONITOR)


def _scores(s, d):
    return weekly.scored(_grid(s, d), ad.RULES)


def _facts(s, d):
    return ad.assignments(s, d)


def _dim(s, d):
    described = topics.describe(ad.assignments(s, d), 5)
    return wh.topic_dimension(ad.topics(s, d).join(described, "topic_id"))


def _usable(s, d):
    return splits.usable(ad.narratives(s, d), "complaint_id", "date_received", "product", "narrative")


def _stages(s, d):
    return splits.staged(_usable(s, d), ad.WINDOWS, "complaint_id", "date_received", "product")


def _split(name: str) -> Query:
    return lambda s, d: splits.kept(_stages(s, d), name).select("complaint_id", "date_received", "product", "issue", "narrative_hash", "split")


def _matrix(s, d):
    return metrics.confusion(ad.predictions(s, d))


def _source(s, d):
    return ad.source(s, d).withColumn("day", parsed_date(F.col("date_text")))


def _vector_search(s, d):
    v = ad.vectors(s, d)
    return retrieval.dense_top_k(v.filter("doc_id % 20 = 0"), v, 5)


def _judged(s, d):
    v = ad.vectors(s, d)
    corpus, test = v.filter("doc_id % 20 <> 0"), v.filter("doc_id % 20 = 0")
    return retrieval.judged(retrieval.dense_top_k(test, corpus, 5), test, corpus, "product"), corpus


def _corpus(s, d):
    return tfidf.Corpus(ad.narratives(s, d), "complaint_id", "narrative", ngram_max=1)


def _kmeans(s, d):
    """Topic of each vector by the best of three K-Means candidates: ids, labels and topic."""
    rows = models.unit(ad.vectors(s, d), "vector")
    model, _ = topics.fit_candidates(rows, [4, 8], n_init=1, max_iterations=20)
    return topics.assign(model, rows, ["doc_id", "product"])


def _kmeans_candidates(s, d):
    rows = models.unit(ad.vectors(s, d), "vector")
    _, tried = topics.fit_candidates(rows, [4, 8], n_init=1, max_iterations=20)
    return s.createDataFrame([vars(t) for t in tried])


def _parts(s, d):
    """The kept rows of each split, written once: models read them many times."""
    path = shared_folder(s, "kept-rows")
    splits.kept(_stages(s, d)).select("complaint_id", "product", "narrative", "split").write.partitionBy("split").parquet(path)
    kept = s.read.schema("complaint_id long, product string, narrative string, split string").parquet(path)
    return {n: kept.filter(F.col("split") == n) for n in ad.WINDOWS}


def _classifier(s, d):
    """Test-split predictions of the text classifier chosen on the validation split."""
    part = _parts(s, d)
    got = models.train(part["train"], part["validation"], part["test"], text_col="narrative", label_col="product", candidates=[0.5, 1.0], max_iterations=25, min_df=5, max_features=2000, ngram_max=1)
    return got["predictions"]


def _indexed(s, d):
    """Metadata, vocabulary and weights of the distinct narratives, each by its smallest id; they are written once and read for each."""
    rows = ad.narratives(s, d).select(text_hash(F.col("narrative")).alias("narrative_hash"), F.struct("complaint_id", "product", "narrative").alias("r"))
    docs = rows.groupBy("narrative_hash").agg(F.min("r").alias("r")).select("narrative_hash", "r.*")
    path = shared_folder(s, "distinct-texts")
    docs.write.parquet(path)
    docs = s.read.parquet(path)
    return retrieval.index(docs, "complaint_id", "narrative", ["product"], "narrative_hash", ngram_max=1, min_df=2)


def _text_search(s, d):
    """The five texts nearest to the benchmark's first item, by TF-IDF cosine."""
    meta, terms, corpus = _indexed(s, d)
    text = s.read.parquet(f"{d}/benchmark.parquet").orderBy("item_id").first()["text"]
    return retrieval.search(terms, corpus, meta, text, 5, ngram_max=1)


def _index_size(s, d):
    meta, terms, corpus = _indexed(s, d)
    return meta.agg(F.count("*").alias("documents")).crossJoin(terms.agg(F.count("*").alias("terms"))).crossJoin(corpus.agg(F.count("*").alias("non_zeros")))  # one row each


#: Words that the stop-word query leaves out.
STOP = ["de", "la", "of", "the"]


def _gram_weights(s, d):
    """Weights of the 400 most frequent of all words and pairs of words, without stop words."""
    corpus = tfidf.Corpus(ad.narratives(s, d), "complaint_id", "narrative", ngram_max=2, stop=STOP)
    return corpus.weights(min_df=3, max_df=0.9, max_features=400)


def _padded_states(s, d):
    """What the splits make of labels and texts with white space around them; the first row by date, then id, stays."""
    i = F.col("complaint_id")
    pad = lambda c, k: F.when(i % 3 == k, F.concat(F.lit(" \t"), c)).when(i % 3 == k + 1, F.concat(c, F.lit("\n "))).otherwise(c)
    rows = ad.narratives(s, d).withColumns({"product": pad(F.col("product"), 0), "narrative": pad(F.col("narrative"), 1)})
    rows = splits.usable(rows, "complaint_id", "date_received", "product", "narrative")
    return splits.staged(rows, ad.WINDOWS, "complaint_id", "date_received", "product").select("complaint_id", "product", F.char_length("narrative").cast("long").alias("characters"), "split", "state")


def _fit_rows(s, d):
    """Training and validation rows together, which the chosen model is fitted on."""
    stages = _stages(s, d).cache()
    both = splits.kept(stages, "train").unionByName(splits.kept(stages, "validation"))
    return both.groupBy("product").agg(F.count("*").alias("rows"), F.countDistinct("narrative_hash").alias("texts"))


def _model_summary(s, d):
    p = ad.predictions(s, d)
    majority = metrics.confusion(metrics.majority_predictions(p, p))
    return wh.model_summary(metrics.summary(metrics.confusion(p)), metrics.summary(majority), metrics.calibration_summary(p, ad.CLASSES))


def _csv_source(s, d):
    """The text-typed source, written as CSV and read back; absent fields are null, blank ones stay."""
    path = shared_folder(s, "source-csv")
    write_csv(ad.source(s, d), path)
    back = files.read_csv(s, path, ["complaint_id", "date_text", "product", "issue", "narrative"])
    return back.select("complaint_id", parsed_date(F.col("date_text")).alias("day"), stripped(F.col("product")).alias("product"), "issue", text_hash(F.col("narrative")).alias("narrative_hash"))


def _csv_assignments(s, d):
    path = shared_folder(s, "assignments-csv")
    write_csv(ad.assignments(s, d), path)
    return files.read_assignments(s, path).groupBy("date_received", "topic_id").agg(F.count("*").alias("rows"))


def _csv_weekly(s, d):
    """The weekly table through CSV and back to its types."""
    path = shared_folder(s, "weekly") + ".csv"
    write_csv(weekly.with_terms(_scores(s, d), ad.topics(s, d), 2), path)
    return _rounded(stages.typed_weekly(s, path)).select("topic_id", "week_start", "topic_count", "total_complaints", "topic_share", "history_weeks", "robust_z_score", "candidate_signal", "alert", "severity", "topic_terms")


def _published(s, d):
    """Rows of each view that is published over the warehouse tables."""
    scores = _scores(s, d)
    tables = {"fact_complaint_topic": _facts(s, d), "fact_weekly_topic_metric": scores, "fact_risk_alert": weekly.alerts(scores), "dim_topic": _dim(s, d), "fact_model_summary": _model_summary(s, d)}
    tables["fact_model_class_metric"] = wh.class_metrics(metrics.per_class(_matrix(s, d)).select(F.col("label").alias("product"), "precision", "recall", F.col("f1").alias("f1_score"), "support"))
    out = None
    for name in wh.publish(s, tables):
        rows = s.table(name).agg(F.lit(name).alias("view_name"), F.count("*").alias("rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _prepared(s, d):
    """The preparation stage's table from a source with its own column names."""
    names = {"complaint_id": "Complaint ID", "date_text": "Date received", "product": "Product", "issue": "Issue", "narrative": "Consumer complaint narrative"}
    source = ad.source(s, d).withColumnsRenamed(names)
    out = stages.prepared(source, ["complaint_id", "date_received", "product", "issue", "narrative"])
    return out.select("complaint_id", "date_received", "product", "issue", text_hash(F.col("narrative")).alias("narrative_hash"))


def _guarded(s, d):
    """Whether each guard lets sound rows pass and refuses the others."""

    def refused(act) -> bool:
        try:
            act()
        except (ValueError, RuntimeError):
            return True
        return False

    docs = ad.narratives(s, d)
    facts = _facts(s, d)
    undated = facts.withColumn("date_received", F.when(F.col("complaint_id") > 1, F.col("date_received")))
    seen = [
        ("text column", refused(lambda: guards.forbid_text_columns(docs, "t")), refused(lambda: guards.forbid_text_columns(facts, "t"))),
        ("missing column", refused(lambda: guards.require_columns(docs, ["none"], "t")), refused(lambda: guards.require_columns(docs, ["issue"], "t"))),
        ("missing date", refused(lambda: weekly.grid(undated, *ad.MONITOR).count()), refused(lambda: weekly.grid(facts, *ad.MONITOR).count())),
        ("blank split rows", refused(lambda: files.load_split(docs.withColumn("product", F.lit(" ")), "narrative", "product")), refused(lambda: files.load_split(_usable(s, d), "narrative", "product"))),
        ("shared texts", refused(lambda: retrieval.require_no_overlap(docs, docs, "narrative")), refused(lambda: retrieval.require_no_overlap(docs.filter("false"), docs, "narrative"))),
    ]
    return s.createDataFrame(seen, "guard string, refuses_bad boolean, refuses_good boolean")


def _archived(s, d):
    """A ZIP of the nations' names: acquired, inspected, verified and extracted, with what is refused."""
    names = "\n".join(r.n_name for r in s.read.parquet(f"{d}/nation.parquet").orderBy("n_nationkey").collect())
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("names.txt", names)
    body = packed.getvalue()

    class Response(io.BytesIO):
        status = 200
        headers = {"Content-Type": "application/zip", "Content-Length": str(len(body))}

    def refused(act) -> bool:
        try:
            act()
        except (ValueError, FileExistsError):
            return True
        return False

    with tempfile.TemporaryDirectory() as folder:  # the driver's own: nothing here is read by executors
        at = Path(folder)
        archives.acquire("http://example.org/a.zip", at / "a.zip", at / "a.json", len(body), open_url=lambda *_, **__: Response(body))
        said = archives.load_metadata(at / "a.json")
        archives.verify_archive(at / "a.zip", said)
        got = archives.extract_member(at / "a.zip", "names.txt", at / "names.txt")
        write_json(got, str(at / "report.json"))
        bad = [refused(lambda n=n: archives.check_member_name(n)) for n in ("../x", "/x", "a/../../x", "C:\\x")]
        row = (
            archives.inspect_zip(at / "a.zip")[0]["filename"],
            files.read_json(str(at / "report.json"))["bytes"],
            got["sha256"],
            sum(bad),
            refused(lambda: archives.extract_member(at / "a.zip", "names.txt", at / "names.txt")),
            refused(lambda: archives.verify_archive(at / "a.zip", said | {"sha256": "0"})),
            refused(lambda: archives.inspect_zip(at / "names.txt")),
        )
    return s.createDataFrame([row], "filename string, bytes long, sha256 string, unsafe_refused int, existing_refused boolean, other_refused boolean, plain_refused boolean")


def _single_csv(s, d):
    """Provenance of a table exported as one CSV file, and its checksum read in parallel."""
    with tempfile.TemporaryDirectory() as folder:
        said = write_single_csv(s.read.parquet(f"{d}/region.parquet").orderBy("r_regionkey").select("r_regionkey", "r_name"), f"{folder}/region.csv")
    path = shared_folder(s, "region-csv")
    s.read.parquet(f"{d}/region.parquet").orderBy("r_regionkey").select("r_regionkey", "r_name").coalesce(1).write.option("header", True).csv(path)
    read = files.checksums(s, f"{path}/*.csv")
    return read.select(F.lit(said["bytes"]).cast("long").alias("exported_bytes"), F.lit(said["sha256"]).alias("exported_sha256"), "bytes", "sha256")


def _saved_model(s, d):
    """Test rows, and of them those that the saved and loaded model judges otherwise than the one that was fitted."""
    part = _parts(s, d)
    train, test = part["train"], part["test"]
    fitted = models.fit_features(train, "narrative", min_df=5, max_features=300, ngram_max=1)
    model = models.fit_classifier(fitted.transform(train, "narrative", ["product"]).cache(), "product", max_iterations=5)
    path = shared_folder(s, "text-model")
    models.save_text_model(s, fitted, model, path)
    features, loaded = models.load_text_model(s, path)
    own = models.predict(model, fitted.transform(test, "narrative", ["complaint_id", "product"]), "product", ["complaint_id"])
    other = models.predict(loaded, features.transform(test, "narrative", ["complaint_id", "product"]), "product", ["complaint_id"])
    both = own.join(other.select("complaint_id", F.col("prediction").alias("again"), F.col("probability").alias("p")), "complaint_id")
    differs = (F.col("prediction") != F.col("again")) | F.exists(F.zip_with("probability", "p", lambda a, b: F.abs(a - b)), lambda x: x > 1e-9)
    return both.agg(F.count("*").alias("rows"), F.count_if(differs).alias("differing"))


def _kmeans_nearest(s, d):
    """Vectors, and those that K-Means did not give to their nearest centre."""
    rows = models.unit(ad.vectors(s, d), "vector")
    model, _ = topics.fit_candidates(rows, [4], n_init=1, max_iterations=20)
    centres = F.array(*[F.array(*map(F.lit, map(float, c))) for c in model.clusterCenters()])
    own = topics.assign(model, rows.withColumn("unit", vector_to_array("features")), ["unit"])
    away = F.transform(centres, lambda c: F.aggregate(F.zip_with(c, "unit", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))
    own = own.withColumn("away", away)
    return own.agg(F.count("*").alias("rows"), F.count_if(F.element_at("away", F.col("topic_id") + 1) > F.array_min("away") + 1e-9).alias("misplaced"))


def _validated(s, d):
    scores = _scores(s, d)
    return wh.checks(_facts(s, d).filter(F.col("date_received").between(*map(F.lit, ad.MONITOR))), scores, weekly.alerts(scores), *ad.MONITOR).withColumn("maximum_weekly_share_sum_error", F.col("maximum_weekly_share_sum_error") < 1e-8)


def queries() -> dict[str, Query]:
    at = ad.MONITOR
    return {
        # monitoring
        "weekly_topic_grid": lambda s, d: _rounded(_grid(s, d), 9),
        "weekly_topic_scores": lambda s, d: _rounded(_scores(s, d)),
        "weekly_candidates": lambda s, d: _rounded(_scores(s, d).filter("candidate_signal")).select("topic_id", "week_start", "topic_count", "robust_z_score", "persistent_signal_count"),
        "weekly_alerts": lambda s, d: _rounded(weekly.alerts(_scores(s, d))).select("topic_id", "week_start", "topic_count", "share_increase", "robust_z_score", "severity"),
        "alert_severity_mix": lambda s, d: _scores(s, d).groupBy("severity").agg(F.count("*").alias("topic_weeks")),
        "top_alerts": lambda s, d: _rounded(weekly.top_alerts(_scores(s, d))),
        "topic_terms_lookup": lambda s, d: weekly.with_terms(_grid(s, d).select("topic_id", "week_start"), ad.topics(s, d), 2),
        "monitoring_coverage": lambda s, d: weekly.coverage(_scores(s, d)),
        # warehouse
        "complaint_detail_view": lambda s, d: wh.complaint_detail(_facts(s, d)),
        "topic_catalog_view": lambda s, d: _dim(s, d),
        "weekly_dashboard_view": lambda s, d: _rounded(wh.weekly_dashboard(_scores(s, d), _dim(s, d))),
        "alert_dashboard_view": lambda s, d: _rounded(wh.alert_dashboard(weekly.alerts(_scores(s, d)), _dim(s, d))),
        "product_topic_summary": lambda s, d: wh.product_topic_summary(_facts(s, d)),
        "weekly_overview": lambda s, d: _rounded(wh.weekly_overview(_scores(s, d))),
        "reconciliation_counts": lambda s, d: wh.reconciliation(_grid(s, d), _facts(s, d), *at),
        "database_checks": _validated,
        "bi_measures": lambda s, d: _rounded((lambda x: wh.bi_measures(_facts(s, d), x, weekly.alerts(x)))(_scores(s, d))),
        "alert_drillthrough": lambda s, d: wh.drillthrough(_facts(s, d), 2, dt.date(1998, 3, 2)),
        "product_counts": lambda s, d: wh.counts_by(_facts(s, d), "product"),
        "issue_counts": lambda s, d: wh.counts_by(_facts(s, d), "issue"),
        "state_counts": lambda s, d: wh.counts_by(_facts(s, d), "state"),
        # profile
        "schema_scan_summary": lambda s, d: profile.schema_scan(ad.source(s, d), "complaint_id", parsed_date(F.col("date_text")), "narrative", "product", "issue"),
        "null_counts": lambda s, d: profile.null_counts(ad.source(s, d)),
        "top_labels": lambda s, d: profile.top_labels(ad.source(s, d), "issue"),
        "filtering_funnel": lambda s, d: profile.funnel(ad.source(s, d), "narrative"),
        "quality_counts": lambda s, d: profile.quality_counts(ad.source(s, d), parsed_date(F.col("date_text")), "product", "issue"),
        "duplicate_text_stats": lambda s, d: profile.duplicate_stats(ad.narratives(s, d), "narrative"),
        "length_quantiles": lambda s, d: profile.length_quantiles(ad.narratives(s, d), "narrative"),
        "coverage_by_label": lambda s, d: profile.coverage(ad.source(s, d), "product", "narrative"),
        "coverage_by_issue": lambda s, d: profile.coverage(ad.source(s, d), "issue", "narrative"),
        "weekly_volume": lambda s, d: profile.weekly_volume(_source(s, d), "day", "narrative"),
        "monthly_volume": lambda s, d: profile.monthly_volume(_source(s, d), "day", "narrative"),
        "prepared_narratives": lambda s, d: _source(s, d).filter(stripped(F.col("narrative")) != "").select("complaint_id", iso(F.col("day")).alias("date_received"), "product", "issue", text_hash(F.col("narrative")).alias("narrative_hash")),
        "narrative_hashes": lambda s, d: ad.narratives(s, d).select("complaint_id", text_hash(F.col("narrative")).alias("narrative_hash"), F.char_length(stripped(F.col("narrative"))).cast("long").alias("characters"), word_count(F.col("narrative")).alias("words")),
        "date_functions": lambda s, d: _source(s, d).select("complaint_id", "day", monday(F.col("day")).alias("week_start"), month(F.col("day")).alias("month"), iso(F.col("day")).alias("iso")),
        # splits
        "split_train": _split("train"),
        "split_validation": _split("validation"),
        "split_test": _split("test"),
        "split_padded_states": _padded_states,
        "split_fit_rows": _fit_rows,
        "split_stats": lambda s, d: splits.statistics(_stages(s, d)),
        "split_labels": lambda s, d: splits.label_distribution(_stages(s, d), "product"),
        "split_overlap": lambda s, d: splits.overlaps(_stages(s, d)),
        "split_outside": lambda s, d: splits.outside(_usable(s, d), ad.narratives(s, d), {k: v for k, v in ad.WINDOWS.items() if k != "validation"}, "date_received"),
        # metrics
        "confusion_matrix": _matrix,
        "confusion_normalised": lambda s, d: _rounded(metrics.normalised(_matrix(s, d))),
        "class_metrics": lambda s, d: _rounded(metrics.per_class(_matrix(s, d))),
        "aggregate_metrics": lambda s, d: metrics.summary(_matrix(s, d)),
        "majority_reference": lambda s, d: metrics.summary(metrics.confusion(metrics.majority_predictions(ad.predictions(s, d), ad.predictions(s, d)))),
        "label_set": lambda s, d: metrics.labels_of(ad.predictions(s, d), ad.predictions(s, d).select(F.col("prediction").alias("truth"))).withColumnRenamed("actual", "label"),
        "top_confusions": lambda s, d: metrics.top_confusions(_matrix(s, d), 5),
        "calibration_bins": lambda s, d: metrics.calibration_bins(ad.predictions(s, d), ad.CLASSES),
        "calibration_summary": lambda s, d: metrics.calibration_summary(ad.predictions(s, d), ad.CLASSES),
        "model_summary_view": _model_summary,
        "model_class_table": lambda s, d: _rounded(wh.class_metrics(metrics.per_class(_matrix(s, d)).select(F.col("label").alias("product"), "precision", "recall", F.col("f1").alias("f1_score"), "support"))),
        # retrieval
        "cosine_topk": lambda s, d: _rounded(_vector_search(s, d)),
        "retrieval_metrics": lambda s, d: (lambda x: retrieval.summary(x[0], x[1], "product"))(_judged(s, d)),
        "retrieval_metrics_by_class": lambda s, d: retrieval.by_class(_judged(s, d)[0]),
        "class_priors": lambda s, d: _rounded(retrieval.class_priors(ad.vectors(s, d), "product")),
        "balanced_query_sample": lambda s, d: retrieval.sampled_queries(ad.vectors(s, d), "doc_id", "product", 10).select("doc_id", "product"),
        "term_document_frequency": lambda s, d: _rounded(_corpus(s, d).vocabulary(min_df=3, max_df=0.7)),
        "tfidf_weights": lambda s, d: _rounded(_corpus(s, d).weights(min_df=3)),
        "topic_tokens": lambda s, d: ad.narratives(s, d).select("complaint_id", F.size(tokens(F.col("narrative"), TOPIC_TOKEN)).cast("long").alias("n_tokens")),
        "text_search": _text_search,
        "text_index_size": _index_size,
        "tfidf_gram_weights": lambda s, d: _rounded(_gram_weights(s, d)),
        # files
        "csv_source_rows": _csv_source,
        "csv_assignments": _csv_assignments,
        "csv_weekly_table": _csv_weekly,
        "prepared_table": _prepared,
        "published_views": _published,
        "guard_outcomes": _guarded,
        "archive_round_trip": _archived,
        "single_csv_provenance": _single_csv,
        # topics and models
        "cluster_sizes": lambda s, d: topics.cluster_sizes(ad.assignments(s, d), 7),
        "cluster_description": lambda s, d: topics.describe(ad.assignments(s, d), 7),
        "kmeans_topics": _kmeans,
        "kmeans_nearest": _kmeans_nearest,
        "saved_model_agrees": _saved_model,
        "kmeans_candidates": _kmeans_candidates,
        "classifier_predictions": lambda s, d: _classifier(s, d).select("truth", "prediction"),
        "classifier_metrics": lambda s, d: metrics.summary(metrics.confusion(_classifier(s, d))),
    }


# -- DuckDB ---------------------------------------------------------------------------------------

_A = """a AS (
  SELECT o_orderkey AS complaint_id, CAST(o_orderdate AS DATE) AS date_received, o_orderstatus AS product, o_orderpriority AS issue,
    'company ' || CAST(o_custkey % 10 AS VARCHAR) AS company, 'S' || CAST(o_custkey % 7 AS VARCHAR) AS state, 'Web' AS submitted_via,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS topic_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start
  FROM orders)"""
_G = (
    _A
    + """, sel AS (
  SELECT * FROM a WHERE date_received BETWEEN DATE '1995-01-02' AND DATE '2001-07-29'
), wk AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-02', TIMESTAMP '2001-07-29', INTERVAL 7 DAY)) AS DATE) AS week_start
), cell AS (
  SELECT t.topic_id, wk.week_start, count(sel.complaint_id) AS topic_count
  FROM (SELECT DISTINCT topic_id FROM sel) t CROSS JOIN wk LEFT JOIN sel ON sel.topic_id = t.topic_id AND sel.week_start = wk.week_start
  GROUP BY 1, 2
), g AS (
  SELECT topic_id, week_start, topic_count, CAST(sum(topic_count) OVER (PARTITION BY week_start) AS BIGINT) AS total_complaints,
    CASE WHEN sum(topic_count) OVER (PARTITION BY week_start) > 0 THEN topic_count::DOUBLE / sum(topic_count) OVER (PARTITION BY week_start) ELSE 0::DOUBLE END AS topic_share
  FROM cell)"""
)
_S = (
    _G
    + """, h AS (
  SELECT *, count(*) OVER w AS history_weeks, list(topic_share) OVER w AS hist, avg(topic_count) OVER w AS mean_count
  FROM g WINDOW w AS (PARTITION BY topic_id ORDER BY week_start ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)
), b AS (
  SELECT *, list_aggregate(hist, 'median') AS med FROM h
), c AS (
  SELECT *, CASE WHEN history_weeks >= 6 THEN med END AS baseline_share_median,
    CASE WHEN history_weeks >= 6 THEN greatest(1.4826::DOUBLE * list_aggregate(list_transform(hist, lambda x: abs(x - med)), 'median'), 0.01::DOUBLE) END AS baseline_share_scale,
    CASE WHEN history_weeks >= 6 THEN mean_count END AS baseline_count_mean
  FROM b
), e AS (
  SELECT *, topic_share - baseline_share_median AS share_increase, (topic_share - baseline_share_median) / baseline_share_scale AS robust_z_score FROM c
), f AS (
  SELECT *, coalesce(robust_z_score >= 2.0::DOUBLE AND topic_count >= 5 AND share_increase >= 0.01::DOUBLE, false) AS candidate_signal FROM e
), k AS (
  SELECT *, CAST(sum(CAST(candidate_signal AS INTEGER)) OVER (PARTITION BY topic_id ORDER BY week_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS persistent_signal_count FROM f
), s AS (
  SELECT topic_id, week_start, topic_count, total_complaints, topic_share, history_weeks, baseline_share_median, baseline_share_scale, baseline_count_mean, share_increase, robust_z_score,
    candidate_signal, persistent_signal_count, candidate_signal AND persistent_signal_count >= 1 AS alert,
    CASE WHEN candidate_signal AND persistent_signal_count >= 1 AND robust_z_score >= 7 THEN 'high' WHEN candidate_signal AND persistent_signal_count >= 1 THEN 'review' ELSE 'none' END AS severity
  FROM k)"""
)
_DESC = """td AS (
  SELECT topic_id, count(*) AS n_all FROM a GROUP BY 1
), tp AS (
  SELECT topic_id, product, count(*) AS n, row_number() OVER (PARTITION BY topic_id ORDER BY count(*) DESC, product) AS place FROM a GROUP BY 1, 2
), dd AS (
  SELECT td.topic_id, td.n_all AS historical_rows, tp.product AS dominant_product, round(tp.n::DOUBLE / td.n_all, 6) AS dominant_product_share,
    (SELECT count(*) FROM tp x WHERE x.topic_id = td.topic_id) AS product_count
  FROM td JOIN tp ON tp.topic_id = td.topic_id AND tp.place = 1
), tt AS (
  SELECT DISTINCT topic_id, list_concat(regexp_split_to_array(lower(issue), '[ -]+'), ['order', 'status', 'week', 'more']) AS terms FROM a WHERE topic_id < 4
), dim AS (
  SELECT dd.topic_id, array_to_string(tt.terms, ', ') AS top_terms, historical_rows, dominant_product, dominant_product_share, product_count FROM dd JOIN tt USING (topic_id))"""
_TRIM = r"regexp_replace(coalesce({0}, ''), '^[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+|[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+$', '', 'g')"
_T = _TRIM.format("narrative")
_N = f"""n0 AS (
  SELECT doc_id AS complaint_id, CAST(DATE '2023-09-01' + CAST(doc_id % 213 AS INTEGER) AS DATE) AS date_received, lang AS product, source AS issue, text AS narrative FROM documents
), n AS (
  SELECT *, {_T} AS t FROM n0)"""
_SRC = f"""q0 AS (
  SELECT CAST(doc_id - CASE WHEN doc_id % 50 = 7 THEN 1 ELSE 0 END AS VARCHAR) AS complaint_id,
    CASE WHEN doc_id % 41 = 3 THEN 'not a date' ELSE strftime(DATE '2023-09-01' + CAST(doc_id % 213 AS INTEGER), '%m/%d/%Y') END AS date_text,
    CASE WHEN doc_id % 29 = 5 THEN NULL WHEN doc_id % 31 = 6 THEN '  ' ELSE lang END AS product,
    CASE WHEN doc_id % 37 = 1 THEN NULL ELSE source END AS issue,
    CASE WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 23 = 2 THEN ' ' || chr(9) || chr(10) ELSE '  ' || text || chr(10) END AS narrative
  FROM documents
), q AS (
  SELECT *, CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE) AS day, {_T} AS t, trim(coalesce(product, '')) AS p, trim(coalesce(issue, '')) AS i FROM q0)"""
_SPLIT = (
    _N
    + """, u AS (
  SELECT *, sha256(t) AS narrative_hash, CASE WHEN date_received <= DATE '2023-12-31' THEN 'train' WHEN date_received <= DATE '2024-02-29' THEN 'validation' ELSE 'test' END AS split
  FROM n WHERE t <> '' AND trim(product) <> '' AND date_received BETWEEN DATE '2023-09-01' AND DATE '2024-03-31'
), c1 AS (
  SELECT narrative_hash FROM u WHERE split = 'train' GROUP BY 1 HAVING count(DISTINCT product) > 1
), k1 AS (
  SELECT DISTINCT narrative_hash FROM u WHERE split = 'train' AND narrative_hash NOT IN (SELECT * FROM c1)
), c2 AS (
  SELECT narrative_hash FROM u WHERE split = 'validation' AND narrative_hash NOT IN (SELECT * FROM k1) GROUP BY 1 HAVING count(DISTINCT product) > 1
), k2 AS (
  SELECT * FROM k1 UNION SELECT narrative_hash FROM u WHERE split = 'validation' AND narrative_hash NOT IN (SELECT * FROM k1) AND narrative_hash NOT IN (SELECT * FROM c2)
), c3 AS (
  SELECT narrative_hash FROM u WHERE split = 'test' AND narrative_hash NOT IN (SELECT * FROM k2) GROUP BY 1 HAVING count(DISTINCT product) > 1
), st AS (
  SELECT *, CASE
    WHEN split = 'validation' AND narrative_hash IN (SELECT * FROM k1) THEN 'seen_earlier'
    WHEN split = 'test' AND narrative_hash IN (SELECT * FROM k2) THEN 'seen_earlier'
    WHEN split = 'train' AND narrative_hash IN (SELECT * FROM c1) THEN 'conflicting'
    WHEN split = 'validation' AND narrative_hash IN (SELECT * FROM c2) THEN 'conflicting'
    WHEN split = 'test' AND narrative_hash IN (SELECT * FROM c3) THEN 'conflicting'
    WHEN row_number() OVER (PARTITION BY split, narrative_hash ORDER BY date_received, complaint_id) > 1 THEN 'repeated' ELSE 'kept' END AS state
  FROM u)"""
)
_P = """p0 AS (
  SELECT doc_id, lang AS truth, 0.4::DOUBLE + (doc_id % 6)::DOUBLE / 10 AS peak, CASE WHEN doc_id % 5 = 0 THEN ['de', 'en', 'es', 'fr'][CAST(doc_id % 4 + 1 AS INTEGER)] ELSE lang END AS prediction FROM documents
), p AS (
  SELECT *, list_transform(['de', 'en', 'es', 'fr'], lambda c: CASE WHEN c = prediction THEN peak ELSE (1 - peak) / 3 END) AS probability FROM p0
), lab AS (
  SELECT truth AS l FROM p UNION SELECT prediction FROM p
), m AS (
  SELECT x.l AS actual, y.l AS predicted, (SELECT count(*) FROM p WHERE truth = x.l AND prediction = y.l) AS n FROM lab x CROSS JOIN lab y
), pc AS (
  SELECT l AS label, CAST(sum(CASE WHEN actual = l THEN n ELSE 0 END) AS BIGINT) AS support, CAST(sum(CASE WHEN predicted = l THEN n ELSE 0 END) AS BIGINT) AS predicted_rows,
    CAST(sum(CASE WHEN actual = l AND predicted = l THEN n ELSE 0 END) AS BIGINT) AS hit
  FROM m, lab GROUP BY l
), pm AS (
  SELECT label, CASE WHEN predicted_rows > 0 THEN hit::DOUBLE / predicted_rows ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit::DOUBLE / support ELSE 0 END AS recall,
    CASE WHEN support + predicted_rows > 0 THEN 2 * hit::DOUBLE / (support + predicted_rows) ELSE 0 END AS f1, support, predicted_rows FROM pc
), jd AS (
  SELECT truth, probability, list_max(probability) AS confidence, ['de', 'en', 'es', 'fr'][list_position(probability, list_max(probability))] AS guess FROM p
), j AS (
  SELECT *, guess = truth AS correct, least(greatest(probability[list_position(['de', 'en', 'es', 'fr'], truth)], 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS own,
    list_sum(list_transform(probability, lambda x: x * x)) AS sq FROM jd
), ed AS (
  SELECT CAST(i AS INTEGER) AS bin, CASE WHEN i = 10 THEN 1::DOUBLE ELSE i * 0.1::DOUBLE END AS lo, CASE WHEN i = 9 THEN 1::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS hi FROM range(10) t(i))"""
_V = """v AS (
  SELECT vec_id AS doc_id, 'class ' || CAST(label AS VARCHAR) AS product, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), un AS (
  SELECT doc_id, product, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u FROM v
)"""
_JUDGED = (
    _V
    + """, sim AS (
  SELECT q.doc_id AS query_id, c.doc_id, q.product AS label, c.product AS found, list_sum(list_transform(range(1, len(q.u) + 1), lambda i: q.u[i] * c.u[i])) AS similarity
  FROM un q JOIN un c ON q.doc_id % 20 = 0 AND c.doc_id % 20 <> 0
), rk AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS r FROM sim
), jq AS (
  SELECT query_id, label, count(*) FILTER (WHERE label = found)::DOUBLE / count(*) AS precision, max(CAST(label = found AS INTEGER)) AS hit, coalesce(1::DOUBLE / min(r) FILTER (WHERE label = found), 0) AS rr
  FROM rk WHERE r <= 5 GROUP BY 1, 2
), pr AS (
  SELECT product AS label, count(*)::DOUBLE / (SELECT count(*) FROM v WHERE doc_id % 20 <> 0) AS prior FROM v WHERE doc_id % 20 <> 0 GROUP BY 1)"""
)
_TF = r"""w AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2
), df AS (
  SELECT term, count(*) AS df, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 3)"""


_TOKEN = r"[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}"
_INDEX = f"""w AS (
  SELECT k.doc_id, unnest(regexp_extract_all(lower(coalesce(n.narrative, '')), '{_TOKEN}')) AS term FROM k JOIN n ON n.complaint_id = k.doc_id
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2
), df AS (
  SELECT term, count(*) AS df, ln((1 + (SELECT count(*) FROM k))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 2
), raw AS (
  SELECT doc_id, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM tf JOIN df USING (term)
), x AS (
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw)"""


def _r(columns: str, places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns.split())


def _metric_sql(cte: str) -> str:
    return f"""WITH {cte} SELECT round(sum(recall * support) / sum(support), 6) AS accuracy, round(avg(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy,
      round(avg(CASE WHEN support > 0 OR predicted_rows > 0 THEN f1 END), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM pm"""


def oracle_sql() -> dict[str, str]:
    base = "baseline_share_median share_increase robust_z_score"
    split = "SELECT complaint_id, date_received, product, issue, narrative_hash, split FROM st WHERE state = 'kept' AND split = '{}'"
    majority = _P.replace("doc_id % 5 = 0 THEN ['de', 'en', 'es', 'fr'][CAST(doc_id % 4 + 1 AS INTEGER)] ELSE lang END", "true THEN (SELECT lang FROM documents GROUP BY 1 ORDER BY count(*) DESC, lang LIMIT 1) END")
    calibration = f"""WITH {_P}, x AS (SELECT bin, count(*) AS n, sum(confidence) AS c, count(*) FILTER (WHERE correct) AS h FROM j JOIN ed ON confidence >= lo AND (confidence < hi OR bin = 9 AND confidence <= hi) GROUP BY 1)
            SELECT (SELECT round(sum(abs(h - c)) / sum(n), 6) FROM x) AS expected_calibration_error, round(avg(-ln(own)), 6) AS multiclass_log_loss, round(avg(sq - 2 * own + 1), 6) AS multiclass_brier_score, round(avg(confidence), 6) AS mean_confidence,
            round(avg(confidence) FILTER (WHERE correct), 6) AS mean_confidence_correct, round(avg(confidence) FILTER (WHERE NOT correct), 6) AS mean_confidence_incorrect FROM j"""
    return {
        "weekly_topic_grid": f"WITH {_G} SELECT topic_id, week_start, topic_count, total_complaints, {_r('topic_share', 9)} FROM g",
        "weekly_topic_scores": f"WITH {_S} SELECT topic_id, week_start, topic_count, total_complaints, history_weeks, candidate_signal, persistent_signal_count, alert, severity, {_r('topic_share baseline_share_scale baseline_count_mean ' + base)} FROM s",
        "weekly_candidates": f"WITH {_S} SELECT topic_id, week_start, topic_count, {_r('robust_z_score')}, persistent_signal_count FROM s WHERE candidate_signal",
        "weekly_alerts": f"WITH {_S} SELECT topic_id, week_start, topic_count, {_r('share_increase robust_z_score')}, severity FROM s WHERE alert",
        "alert_severity_mix": f"WITH {_S} SELECT severity, count(*) AS topic_weeks FROM s GROUP BY 1",
        "top_alerts": f"WITH {_S} SELECT topic_id, week_start, topic_count, persistent_signal_count, severity, {_r('topic_share ' + base)} FROM (SELECT * FROM s WHERE alert ORDER BY robust_z_score DESC, week_start, topic_id LIMIT 10)",
        "topic_terms_lookup": f"WITH {_G}, {_DESC} SELECT g.topic_id, week_start, array_to_string(tt.terms[1:2], ', ') AS topic_terms FROM g LEFT JOIN tt USING (topic_id)",
        "monitoring_coverage": f"WITH {_S} SELECT count(DISTINCT week_start) AS weeks, count(DISTINCT topic_id) AS topics, count(*) AS topic_weeks, count(*) FILTER (WHERE candidate_signal) AS candidates, count(*) FILTER (WHERE alert) AS alerts, count(DISTINCT CASE WHEN alert THEN topic_id END) AS alerted_topics FROM s",
        "complaint_detail_view": f"WITH {_A} SELECT complaint_id, date_received, week_start, product, issue, company, state, submitted_via, topic_id FROM a",
        "topic_catalog_view": f"WITH {_A}, {_DESC} SELECT * FROM dim",
        "weekly_dashboard_view": f"WITH {_S}, {_DESC} SELECT week_start, s.topic_id, top_terms, dominant_product, topic_count, total_complaints, {_r('topic_share ' + base)}, candidate_signal, persistent_signal_count, alert, severity FROM s JOIN dim USING (topic_id)",
        "alert_dashboard_view": f"WITH {_S}, {_DESC} SELECT week_start, s.topic_id, top_terms, dominant_product, topic_count, total_complaints, {_r('topic_share ' + base)}, persistent_signal_count, severity FROM s JOIN dim USING (topic_id) WHERE alert",
        "product_topic_summary": f"WITH {_A} SELECT product, topic_id, count(*) AS complaint_count, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY product), 6) AS share_within_product FROM a GROUP BY 1, 2",
        "weekly_overview": f"WITH {_S} SELECT week_start, max(total_complaints) AS narrative_complaints, count(*) FILTER (WHERE alert) AS alert_count, count(*) FILTER (WHERE candidate_signal) AS candidate_count, count(DISTINCT topic_id) AS monitored_topics, round(max(robust_z_score), 6) AS maximum_robust_z_score FROM s GROUP BY 1",
        "reconciliation_counts": f"WITH {_G}, x AS (SELECT week_start, topic_id, count(*) AS n FROM sel GROUP BY 1, 2) SELECT g.week_start, g.topic_id, topic_count AS monitoring_count, coalesce(n, 0) AS assignment_count, topic_count - coalesce(n, 0) AS count_difference FROM g LEFT JOIN x USING (week_start, topic_id)",
        "database_checks": f"""WITH {_S} SELECT (SELECT count(*) FROM sel) AS complaint_rows, (SELECT count(DISTINCT complaint_id) FROM sel) AS unique_complaint_ids, (SELECT count(*) FROM s) AS weekly_topic_rows,
            (SELECT count(*) FROM s WHERE alert) AS weekly_alert_flag_rows, (SELECT count(*) FROM s WHERE alert) AS alert_rows,
            (SELECT max(abs(x - 1)) < 1e-8 FROM (SELECT sum(topic_share) AS x FROM s GROUP BY week_start)) AS maximum_weekly_share_sum_error, 0::BIGINT AS assignment_monitoring_count_difference""",
        "bi_measures": f"""WITH {_S} SELECT (SELECT count(DISTINCT complaint_id) FROM a) AS complaints, (SELECT CAST(sum(x) AS BIGINT) FROM (SELECT max(total_complaints) AS x FROM s GROUP BY week_start)) AS monitored_complaints,
            (SELECT count(*) FROM s WHERE alert) AS alerts, (SELECT count(DISTINCT topic_id) FROM s WHERE alert) AS alerted_topics, (SELECT round(avg(topic_share), 6) FROM s) AS average_topic_share, (SELECT round(max(robust_z_score), 6) FROM s) AS maximum_robust_z_score""",
        "alert_drillthrough": f"WITH {_A} SELECT complaint_id, date_received, week_start, product, issue, company, state, submitted_via, topic_id FROM a WHERE topic_id = 2 AND week_start = DATE '1998-03-02'",
        "product_counts": f"WITH {_A} SELECT product AS value, count(*) AS complaints FROM a GROUP BY 1",
        "issue_counts": f"WITH {_A} SELECT issue AS value, count(*) AS complaints FROM a GROUP BY 1",
        "state_counts": f"WITH {_A} SELECT state AS value, count(*) AS complaints FROM a GROUP BY 1",
        "schema_scan_summary": f"WITH {_SRC} SELECT count(*) AS source_rows, count(DISTINCT complaint_id) AS distinct_ids, count(complaint_id) - count(DISTINCT complaint_id) AS duplicate_ids, count(*) FILTER (WHERE day IS NULL) AS invalid_dates, min(day) AS minimum_date, max(day) AS maximum_date, count(*) FILTER (WHERE t = '') AS blank_texts, count(DISTINCT product) AS distinct_labels, count(DISTINCT issue) AS distinct_sub_labels FROM q",
        "null_counts": f"WITH {_SRC} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM q" for c in ("complaint_id", "date_text", "product", "issue", "narrative")),
        "top_labels": f"WITH {_SRC} SELECT issue AS label, count(*) AS rows FROM q WHERE issue IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
        "filtering_funnel": f"WITH {_SRC} SELECT count(*) AS source_rows, count(*) FILTER (WHERE t = '') AS rows_without_text, count(*) FILTER (WHERE t <> '') AS rows_kept, round(100::DOUBLE * count(*) FILTER (WHERE t <> '') / count(*), 2) AS retention_pct FROM q",
        "quality_counts": f"WITH {_SRC} SELECT count(*) FILTER (WHERE day IS NULL) AS invalid_dates, count(*) FILTER (WHERE p = '') AS blank_labels, count(*) FILTER (WHERE i = '') AS blank_sub_labels FROM q",
        "duplicate_text_stats": f"WITH {_N}, x AS (SELECT sha256(t) AS h, count(*) AS n FROM n GROUP BY 1) SELECT count(*) AS distinct_hashes, count(*) FILTER (WHERE n > 1) AS repeated_hashes, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS redundant_rows FROM x",
        "length_quantiles": f"WITH {_N}, x AS (SELECT length(t) AS c, CASE WHEN t = '' THEN 0 ELSE len(regexp_split_to_array(t, '[\\s\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{3000}}]+')) END AS w FROM n) "
        + " UNION ALL ".join(f"SELECT {q}::DOUBLE AS quantile, round(quantile_cont(c::DOUBLE, {q}), 2) AS characters, round(quantile_cont(w::DOUBLE, {q}), 2) AS words FROM x" for q in profile.QUANTILES),
        "coverage_by_label": f"WITH {_SRC} SELECT product AS label, count(*) AS total, count(*) FILTER (WHERE t <> '') AS with_text, round(100::DOUBLE * count(*) FILTER (WHERE t <> '') / count(*), 2) AS rate_pct FROM q WHERE product IS NOT NULL GROUP BY 1",
        "coverage_by_issue": f"WITH {_SRC} SELECT issue AS label, count(*) AS total, count(*) FILTER (WHERE t <> '') AS with_text, round(100::DOUBLE * count(*) FILTER (WHERE t <> '') / count(*), 2) AS rate_pct FROM q WHERE issue IS NOT NULL GROUP BY 1",
        "weekly_volume": f"WITH {_SRC} SELECT CAST(CAST(date_trunc('week', day) AS DATE) AS VARCHAR) || '/' || CAST(CAST(date_trunc('week', day) AS DATE) + 6 AS VARCHAR) AS week, CAST(date_trunc('week', day) AS DATE) AS week_start, count(*) AS total, count(*) FILTER (WHERE t <> '') AS with_text FROM q WHERE day IS NOT NULL GROUP BY 1, 2",
        "monthly_volume": f"WITH {_SRC} SELECT strftime(day, '%Y-%m') AS month, count(*) AS with_text FROM q WHERE day IS NOT NULL AND t <> '' GROUP BY 1",
        "prepared_narratives": f"WITH {_SRC} SELECT complaint_id, strftime(day, '%Y-%m-%d') AS date_received, product, issue, sha256(t) AS narrative_hash FROM q WHERE t <> ''",
        "narrative_hashes": f"WITH {_N} SELECT complaint_id, sha256(t) AS narrative_hash, length(t) AS characters, CASE WHEN t = '' THEN 0 ELSE len(regexp_split_to_array(t, '[\\s\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{3000}}]+')) END AS words FROM n",
        "date_functions": f"WITH {_SRC} SELECT complaint_id, day, CAST(date_trunc('week', day) AS DATE) AS week_start, strftime(day, '%Y-%m') AS month, strftime(day, '%Y-%m-%d') AS iso FROM q",
        "split_train": f"WITH {_SPLIT} " + split.format("train"),
        "split_validation": f"WITH {_SPLIT} " + split.format("validation"),
        "split_test": f"WITH {_SPLIT} " + split.format("test"),
        "split_stats": f"WITH {_SPLIT} SELECT split, count(*) AS window_rows, " + ", ".join(f"count(*) FILTER (WHERE state = '{a}') AS {b}" for a, b in (("seen_earlier", "removed_seen_earlier"), ("conflicting", "removed_conflicting"), ("repeated", "removed_repeats"), ("kept", "final_rows"))) + ", count(DISTINCT CASE WHEN state = 'conflicting' THEN narrative_hash END) AS conflicting_hashes FROM st GROUP BY 1",
        "split_labels": f"WITH {_SPLIT} SELECT split, product AS label, count(*) AS rows FROM st WHERE state = 'kept' GROUP BY 1, 2",
        "split_overlap": f"WITH {_SPLIT} SELECT x.split AS split_a, y.split AS split_b, count(*) AS shared FROM st x JOIN st y ON x.narrative_hash = y.narrative_hash AND x.split < y.split AND x.state = 'kept' AND y.state = 'kept' GROUP BY 1, 2",
        "split_outside": f"WITH {_N} SELECT count(*) FILTER (WHERE t = '' OR trim(product) = '') AS invalid_rows, count(*) FILTER (WHERE t <> '' AND date_received BETWEEN DATE '2024-01-01' AND DATE '2024-02-29') AS rows_outside_windows FROM n",
        "confusion_matrix": f"WITH {_P} SELECT actual, predicted, n FROM m",
        "confusion_normalised": f"WITH {_P} SELECT actual, predicted, round(n::DOUBLE / greatest(sum(n) OVER (PARTITION BY actual), 1), 6) AS share FROM m",
        "class_metrics": f"WITH {_P} SELECT label, {_r('precision recall f1')}, support, predicted_rows FROM pm",
        "aggregate_metrics": _metric_sql(_P),
        "majority_reference": _metric_sql(majority),
        "label_set": f"WITH {_P} SELECT l AS label FROM lab",
        "top_confusions": f"WITH {_P}, x AS (SELECT *, sum(n) OVER (PARTITION BY actual) AS t FROM m) SELECT actual, predicted, n, round(100::DOUBLE * n / t, 2) AS share_of_actual_pct FROM x WHERE actual <> predicted AND n > 0 ORDER BY n DESC, actual, predicted LIMIT 5",
        "calibration_bins": f"""WITH {_P} SELECT bin, round(lo, 2) AS lower, round(hi, 2) AS upper, count(confidence) AS n, round(avg(confidence), 6) AS mean_confidence, round(avg(correct::INTEGER::DOUBLE), 6) AS accuracy
            FROM ed LEFT JOIN j ON confidence >= lo AND (confidence < hi OR bin = 9 AND confidence <= hi) GROUP BY 1, 2, 3""",
        "calibration_summary": calibration,
        "model_class_table": f"WITH {_P} SELECT label AS product, {_r('precision recall')}, round(f1, 6) AS f1_score, support FROM pm",
        "cosine_topk": f"""WITH {_V}, sim AS (SELECT q.doc_id AS query_id, c.doc_id, list_sum(list_transform(range(1, len(q.u) + 1), lambda i: q.u[i] * c.u[i])) AS similarity FROM un q JOIN un c ON q.doc_id % 20 = 0 AND q.doc_id <> c.doc_id),
            rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS r FROM sim) SELECT query_id, CAST(r AS INTEGER) AS rank, doc_id, round(similarity, 6) AS similarity FROM rk WHERE r <= 5""",
        "retrieval_metrics": f"WITH {_JUDGED} SELECT count(*) AS query_rows, round(avg(precision), 6) AS precision_at_k, round(avg(hit), 6) AS hit_rate_at_k, round(avg(rr), 6) AS mean_reciprocal_rank, round(avg(coalesce(prior, 0)), 6) AS random_reference, round(avg(precision) / avg(coalesce(prior, 0)), 4) AS lift FROM jq LEFT JOIN pr USING (label)",
        "retrieval_metrics_by_class": f"WITH {_JUDGED} SELECT label, count(*) AS queries, round(avg(precision), 6) AS precision_at_k, round(avg(hit), 6) AS hit_rate_at_k, round(avg(rr), 6) AS mean_reciprocal_rank FROM jq GROUP BY 1",
        "class_priors": f"WITH {_V} SELECT product AS label, round(count(*)::DOUBLE / (SELECT count(*) FROM v), 6) AS prior FROM v GROUP BY 1",
        "balanced_query_sample": f"WITH {_V} SELECT doc_id, product FROM (SELECT *, row_number() OVER (PARTITION BY product ORDER BY sha256(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS r FROM v) WHERE r <= 10",
        "term_document_frequency": f"WITH {_TF} SELECT term, df, round(idf, 6) AS idf FROM df WHERE df <= 0.7::DOUBLE * (SELECT count(*) FROM documents)",
        "tfidf_weights": f"WITH {_TF}, x AS (SELECT doc_id, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM tf JOIN df USING (term)) SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x",
        "text_search": f"""WITH {_N}, k AS (SELECT min(complaint_id) AS doc_id FROM n GROUP BY t), {_INDEX}, b AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1),
            qt AS (SELECT unnest(regexp_extract_all(lower(text), '{_TOKEN}')) AS term FROM b), qf AS (SELECT term, (1 + ln(count(*)::DOUBLE)) * any_value(idf) AS w FROM qt JOIN df USING (term) GROUP BY 1),
            qw AS (SELECT term, w / sqrt((SELECT sum(w * w) FROM qf)) AS w FROM qf), sim AS (SELECT doc_id, sum(qw.w * x.w) AS similarity FROM qw JOIN x USING (term) GROUP BY 1),
            al AS (SELECT k.doc_id, coalesce(similarity, 0) AS similarity, product FROM k JOIN n ON n.complaint_id = k.doc_id LEFT JOIN sim ON sim.doc_id = k.doc_id)
            SELECT CAST(row_number() OVER (ORDER BY similarity DESC, doc_id) AS INTEGER) AS rank, round(similarity, 6) AS similarity, doc_id, product FROM al ORDER BY al.similarity DESC, doc_id LIMIT 5""",
        "text_index_size": f"WITH {_N}, k AS (SELECT min(complaint_id) AS doc_id FROM n GROUP BY t), {_INDEX} SELECT (SELECT count(*) FROM k) AS documents, (SELECT count(*) FROM df) AS terms, (SELECT count(*) FROM x) AS non_zeros",
        "tfidf_gram_weights": f"""WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{_TOKEN}'), lambda x: NOT list_contains({STOP}, x)) AS w FROM documents),
            g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w), tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
            df AS (SELECT term, count(*) AS df, sum(tf) AS total, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 3 AND count(*) <= 0.9::DOUBLE * (SELECT count(*) FROM documents) ORDER BY total DESC, term LIMIT 400),
            x AS (SELECT doc_id, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM tf JOIN df USING (term)) SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""",
        "csv_source_rows": f"WITH {_SRC} SELECT complaint_id, day, p AS product, issue, sha256(t) AS narrative_hash FROM q",
        "csv_assignments": f"WITH {_A} SELECT date_received, topic_id, count(*) AS rows FROM a GROUP BY 1, 2",
        "csv_weekly_table": f"WITH {_S}, {_DESC} SELECT s.topic_id, week_start, topic_count, total_complaints, history_weeks, candidate_signal, alert, severity, {_r('topic_share robust_z_score')}, array_to_string(tt.terms[1:2], ', ') AS topic_terms FROM s LEFT JOIN tt USING (topic_id)",
        "prepared_table": f"WITH {_SRC} SELECT complaint_id, strftime(day, '%Y-%m-%d') AS date_received, product, issue, sha256(t) AS narrative_hash FROM q WHERE t <> ''",
        "published_views": f"""WITH {_S}, {_DESC}, lang AS (SELECT lang FROM documents UNION SELECT ['de', 'en', 'es', 'fr'][CAST(doc_id % 4 + 1 AS INTEGER)] FROM documents WHERE doc_id % 5 = 0)
            SELECT 'vw_complaint_detail' AS view_name, (SELECT count(*) FROM a) AS rows UNION ALL SELECT 'vw_topic_catalog', (SELECT count(*) FROM dim) UNION ALL SELECT 'vw_weekly_topic_dashboard', (SELECT count(*) FROM s JOIN dim USING (topic_id))
            UNION ALL SELECT 'vw_alert_dashboard', (SELECT count(*) FROM s JOIN dim USING (topic_id) WHERE alert) UNION ALL SELECT 'vw_product_topic_summary', (SELECT count(*) FROM (SELECT DISTINCT product, topic_id FROM a))
            UNION ALL SELECT 'vw_weekly_overview', (SELECT count(DISTINCT week_start) FROM s) UNION ALL SELECT 'vw_model_summary', 1 UNION ALL SELECT 'vw_model_class_performance', (SELECT count(*) FROM lang)""",
        "guard_outcomes": "SELECT unnest(['text column', 'missing column', 'missing date', 'blank split rows', 'shared texts']) AS guard, true AS refuses_bad, false AS refuses_good",
        "archive_round_trip": "WITH x AS (SELECT string_agg(n_name, chr(10) ORDER BY n_nationkey) AS t FROM nation) SELECT 'names.txt' AS filename, strlen(t) AS bytes, sha256(t) AS sha256, CAST(4 AS INTEGER) AS unsafe_refused, true AS existing_refused, true AS other_refused, true AS plain_refused FROM x",
        "single_csv_provenance": "WITH x AS (SELECT 'r_regionkey,r_name' || chr(10) || string_agg(CAST(r_regionkey AS VARCHAR) || ',' || r_name || chr(10), '' ORDER BY r_regionkey) AS t FROM region) SELECT strlen(t) AS exported_bytes, sha256(t) AS exported_sha256, strlen(t) AS bytes, sha256(t) AS sha256 FROM x",
        "saved_model_agrees": f"WITH {_SPLIT} SELECT count(*) AS rows, 0::BIGINT AS differing FROM st WHERE state = 'kept' AND split = 'test'",
        "kmeans_nearest": "SELECT count(*) AS rows, 0::BIGINT AS misplaced FROM embeddings",
        "split_padded_states": f"WITH {_SPLIT} SELECT complaint_id, product, length(t) AS characters, split, state FROM st",
        "split_fit_rows": f"WITH {_SPLIT} SELECT product, count(*) AS rows, count(DISTINCT narrative_hash) AS texts FROM st WHERE state = 'kept' AND split IN ('train', 'validation') GROUP BY 1",
        "model_summary_view": f"""SELECT 'tfidf_logistic_regression' AS model_name, a.*, b.accuracy AS majority_accuracy, b.macro_f1 AS majority_macro_f1, c.expected_calibration_error, c.multiclass_log_loss, c.multiclass_brier_score, 'held-out test window' AS evaluation_scope
            FROM ({_metric_sql(_P)}) a, ({_metric_sql(majority)}) b, ({calibration}) c""",
        "topic_tokens": r"SELECT doc_id AS complaint_id, CAST(len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{Nd}\p{Pc}]+'), lambda w: regexp_full_match(w, '[a-z]{2,}'))) AS BIGINT) AS n_tokens FROM documents",
        "cluster_sizes": f"WITH {_A}, r AS (SELECT CAST(i AS INTEGER) AS topic_id FROM range(7) t(i)) SELECT r.topic_id, count(a.complaint_id) AS rows FROM r LEFT JOIN a USING (topic_id) GROUP BY 1",
        "cluster_description": f"WITH {_A}, {_DESC}, r AS (SELECT CAST(i AS INTEGER) AS topic_id FROM range(7) t(i)) SELECT r.topic_id, coalesce(historical_rows, 0) AS historical_rows, dominant_product, dominant_product_share, coalesce(product_count, 0) AS product_count FROM r LEFT JOIN dd USING (topic_id)",
    }
