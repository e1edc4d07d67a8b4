"""All stages end to end over a small source."""

import csv
import datetime as dt
import io
import json
import zipfile

import pytest

from tidemark.__main__ import main
from tidemark.plans import stages
from tidemark.sources import archives

THEMES = {"Card": ["card", "fee", "charge", "limit", "late"], "Loan": ["loan", "rate", "payment", "due", "escrow"]}


@pytest.fixture(scope="module")
def workspace(tmp_path_factory):
    at = tmp_path_factory.mktemp("work")
    names = [*stages.RENAMED, "Tags"]
    text = io.StringIO()
    out = csv.writer(text)
    out.writerow(names)
    for i in range(240):
        product = "Card" if i % 3 else "Loan"
        words = THEMES[product]
        story = " ".join(words[(i * k + k) % 5] for k in range(1, 5)) + f" case{i % 200}x, \"told\""
        day = dt.date(2023, 9, 4) + dt.timedelta(days=i * 206 // 240)
        row = {"Complaint ID": i, "Date received": day.strftime("%m/%d/%Y"), "Product": product, "Issue": f"issue {i % 4}", "Consumer complaint narrative": "" if i % 20 == 7 else f"  {story}\n", "Company": "C", "State": "S", "Submitted via": "Web"}
        out.writerow([row.get(n, "") for n in names])
    with zipfile.ZipFile(at / "a.zip", "w") as z:
        z.writestr("a.csv", text.getvalue())
    said = {"archive_filename": "a.zip", "compressed_bytes": (at / "a.zip").stat().st_size, "sha256": archives.sha256_of(at / "a.zip"), "archive_members": []}
    (at / "m.json").write_text(json.dumps(said))
    return at


def test_stages_end_to_end(spark, workspace):
    p = lambda name: str(workspace / name)
    data = {
        "local": {"archive_path": p("a.zip"), "metadata_path": p("m.json"), "extracted_path": p("a.csv"), "extraction_metadata_path": p("x.json"), "schema_report_path": p("schema.json"), "narrative_dataset_path": p("narratives"), "eda_report_path": p("eda.json")},
        "extraction": {"member_name": "a.csv", "encoding": "utf-8", "delimiter": ",", "required_columns": ["Complaint ID", "Product"]},
        "preparation": {"output_columns": list(stages.RENAMED.values())},
    }
    assert stages.inspection(spark, data)["scan"]["source_rows"] == 240
    with pytest.raises(FileExistsError):
        stages.inspection(spark, data)
    assert stages.preparation(spark, data)["funnel"]["rows_kept"] == 228
    with pytest.raises(ValueError, match="unknown"):
        stages.prepared(spark.createDataFrame([("x",)], ["Product"]), ["nothing"])
    base = {
        "data": {"prepared_path": p("narratives"), "train_path": p("train"), "validation_path": p("validation"), "test_path": p("test"), "split_report_path": p("split.json"), "text_column": "narrative", "target_column": "product", "date_column": "date_received", "id_column": "complaint_id", "hash_column": "narrative_hash"},
        "split": {"train_start": "2023-09-01", "train_end": "2023-12-31", "validation_start": "2024-01-01", "validation_end": "2024-02-15", "test_start": "2024-02-16", "test_end": "2024-03-31"},
        "model": {"min_document_frequency": 1, "max_features": 200, "ngram_max": 1, "max_iterations": 15, "candidates": [{"c": 1.0}], "artifact_path": p("model"), "metrics_path": p("base.json"), "evaluation_report_path": p("evaluation.json")},
    }
    report = stages.splitting(spark, base)
    assert sum(r["final_rows"] for r in report["splits"]) > 80 and report["rows_outside_windows"] == 0
    assert stages.baseline(spark, base)["test_metrics"]["accuracy"] > 0.9
    assert sum(b["n"] for b in stages.evaluation(spark, base)["bins"]) > 0
    search = {"data": base["data"], "retrieval": {"index_path": p("index"), "report_path": p("retrieval.json"), "k": 5, "queries_per_class": 5, "min_df": 1, "ngram_max": 1}}
    assert stages.retrieval_stage(spark, search)["precision_at_k"] > 0.8
    found = stages.retrieval_stage(spark, search, query="loan rate", k=0)
    assert len(found) == 5 and found[0]["product"] == "Loan" and "narrative" not in found[0]
    topics = {
        "data": base["data"] | {"assignments_path": p("assignments"), "retained_columns": ["complaint_id", "date_received", "product", "issue", "company", "state", "submitted_via"]},
        "clustering": {"min_document_frequency": 2, "max_document_frequency": 0.9, "max_features": 100, "ngram_max": 1, "use_english_stop_words": True, "excluded_tokens": ["xx"], "candidate_clusters": [2], "max_iterations": 10, "n_init": 1, "evaluation_sample_size": 100, "minimum_cluster_fraction": 0.0, "top_terms_per_cluster": 3, "model_path": p("kmeans"), "report_path": p("topics.json")},
    }
    assert sum(t["rows"] for t in stages.clustering(spark, topics)["assignment_counts"]) == 228
    risk = {"data": {"assignments_path": p("assignments"), "clustering_report_path": p("topics.json"), "weekly_metrics_path": p("weekly"), "alerts_path": p("alerts"), "report_path": p("risk.json")}, "risk_detection": {"analysis_start": "2023-09-04", "analysis_end": "2024-03-31", "minimum_weekly_count": 3}}
    assert stages.risk_detection(spark, risk)["coverage"]["weeks"] == 30
    views = {"vw_complaint_detail": "complaints.csv", "vw_weekly_overview": "weekly.csv", "vw_model_summary": "model.csv"}
    end = {"data": {"topic_assignments_path": p("assignments"), "weekly_metrics_path": p("weekly"), "alerts_path": p("alerts"), "clustering_report_path": p("topics.json"), "baseline_metrics_path": p("base.json"), "evaluation_report_path": p("evaluation.json")}, "analytics": {"export_directory": p("export"), "report_path": p("analytics.json"), "exports": views}}
    report = stages.analytics(spark, end)
    assert [e["rows"] for e in report["exports"]] == [228, 30, 1] and report["checks"]["assignment_monitoring_count_difference"] == 0


def test_command_line_status(capsys):
    assert main([]) == 0 and "artifacts present" in capsys.readouterr().out
