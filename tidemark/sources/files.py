"""File sources: CSV as text with explicit nulls, Parquet, JSON reports, YAML configuration, models."""

from __future__ import annotations

import csv
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import is_blank
from tidemark.operators.guards import require, require_columns, require_none

#: Field texts that mean missing.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
DELIMITERS = ",\t;|"


def csv_columns(spark: SparkSession, path: str, delimiter: str = ",") -> list[str]:
    """The header of a CSV source."""
    return spark.read.option("header", True).option("sep", delimiter).csv(path).columns


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, delimiter: str = ",", encoding: str = "UTF-8", nulls: list[str] = NULL_TOKENS, schema: T.StructType | None = None) -> DataFrame:
    """A CSV with header as text columns (or the given schema); malformed rows are errors."""
    names = [n.removeprefix("﻿") for n in csv_columns(spark, path, delimiter)]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema or text).option("header", True).option("sep", delimiter).option("encoding", encoding)
    df = reader.option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").option("enforceSchema", True).csv(path)
    if columns is not None:
        df = require_columns(df, columns, path).select(*[F.col(f"`{c}`") for c in columns])
    if schema is None:
        df = df.select(*[F.when(~F.col(f"`{c}`").isin(nulls), F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df


def read_assignments(spark: SparkSession, path: str, day_col: str = "date_received", topic_col: str = "topic_id") -> DataFrame:
    """The two columns that monitoring needs, typed."""
    df = read_csv(spark, path, [day_col, topic_col])
    return df.select(F.try_to_timestamp(F.col(day_col), F.lit("yyyy-MM-dd")).cast("date").alias(day_col), F.col(topic_col).cast("int").alias(topic_col))


def load_split(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """A split with its columns checked; rows without text or label are an error."""
    require_columns(df, (text_col, label_col), "split")
    require_none(df.filter(is_blank(F.col(text_col)) | is_blank(F.col(label_col))), "split rows without text or label")
    return df


def text_format(path: str, encoding: str = "utf-8-sig", delimiter: str = ",", sample: int = 65_536) -> dict:
    """BOM, sniffed delimiter, header and width of the first row of a text file; driver-side.

    A header of one column, or another delimiter than the configured one, is an error.
    """
    with open(path, "rb") as f:
        bom = f.read(3) == b"\xef\xbb\xbf"
    with open(path, encoding=encoding, newline="") as f:
        text = f.read(sample)
        found = csv.Sniffer().sniff(text, delimiters=DELIMITERS).delimiter
        f.seek(0)
        rows = csv.reader(f, delimiter=found)
        header, first = next(rows, []), next(rows, [])
    require(len(header) > 1, "the header has at most one column")
    require(found == delimiter, f"the delimiter is {found!r}, not {delimiter!r}")
    return {"has_bom": bom, "delimiter": found, "header": header, "columns": len(header), "first_row_width": len(first)}


def read_json(path: str) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def load_config(path: str) -> dict:
    """A YAML mapping; a missing file or another content is an error."""
    import yaml

    file = Path(path)
    if not file.is_file():
        raise FileNotFoundError(path)
    said = yaml.safe_load(file.read_text(encoding="utf-8"))
    require(isinstance(said, dict) and bool(said), f"{path} is not a mapping")
    return said


def folder_digest(spark: SparkSession, path: str) -> str:
    """SHA-256 over the sorted SHA-256 digests of the data files under a path, whatever their names."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    held = rows.select(F.sha2("content", 256).alias("sha256"), F.element_at(F.split("path", "/"), -1).alias("name")).filter("not startswith(name, '_') and not startswith(name, '.')")
    return held.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ","), 256)).first()[0]


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of files, read in parallel."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
