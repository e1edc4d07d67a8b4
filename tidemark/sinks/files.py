"""Sinks: CSV folders and single files, JSON reports, view exports with provenance, managed tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.guards import forbid_text_columns
from tidemark.sources.archives import published, sha256_of


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path that driver and executors share, under spark.checkpoint.dir; a temporary folder only where all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-files-")
    return f"{found.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A folder of CSV parts with header, published by Spark's committer; an empty table still has its header."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("escape", '"').csv(path)


def write_single_csv(df: DataFrame, path: str, overwrite: bool = False) -> dict:
    """One CSV file on the driver for a small result, published by rename; returns its provenance.

    One task writes it to the shared folder, from which the driver copies it.
    """
    target, spark = Path(path), df.sparkSession

    def write(part: Path) -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark, "single-csv"))
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        try:
            df.coalesce(1).write.option("header", True).option("escape", '"').csv(folder.toString())
            written = next(f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-"))
            store.copyToLocalFile(False, written, spark._jvm.org.apache.hadoop.fs.Path(part.resolve().as_uri()), True)
        finally:
            store.delete(folder, True)

    published(target, write, overwrite)
    return provenance(target)


def provenance(path: str | Path) -> dict:
    return {"path": str(path), "bytes": Path(path).stat().st_size, "sha256": sha256_of(path)}


def write_json(report: dict, path: str, overwrite: bool = False) -> None:
    published(path, lambda p: p.write_text(json.dumps(report, indent=2, default=str), encoding="utf-8"), overwrite)


def save_tables(tables: Mapping[str, DataFrame], database: str | None = None) -> None:
    """Managed tables; text columns are refused."""
    for name, df in tables.items():
        forbid_text_columns(df, name).write.mode("overwrite").saveAsTable(f"{database}.{name}" if database else name)


def export_views(spark: SparkSession, exports: Mapping[str, str], folder: str, overwrite: bool = False) -> list[dict]:
    """Each view as a CSV file with rows, columns, bytes and SHA-256; text columns are refused."""
    out = []
    for view, name in exports.items():
        df = forbid_text_columns(spark.table(view), view)
        out.append({"view": view, "rows": df.count(), "columns": df.columns} | write_single_csv(df, f"{folder}/{name}", overwrite))
    return out
