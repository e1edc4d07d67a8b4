"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A whole text becomes hashed counts of character-class n-grams (letters by case,
digits and white space by class, every other mark by itself) and a few shares
(repeated words and word triples, marks, capitals, word lengths).  Log counts
times inverse document frequency, at unit length, are reduced by the leading
singular vectors of the labelled sample.  The sample's vectors and labels are
broadcast; their number and so their size is fixed by SAMPLE_ROWS.  For every
document all cosines with them are computed exactly, in blocks; its NEIGHBOURS
nearest vote, each with its similarity to the power SHARPNESS, corrected for
how much rarer or more frequent its label is in the sample than in the table of labels.

Inputs of a score are the text's bytes alone.  Labels are learnt from rows
whose crc32(doc_id as text) mod 5 is not 0.

Defined results: a null or empty text scores 0; with labels of one value every
other text scores that value; without labels every text scores 1 (nothing is
rejected for want of evidence); of several labels of a doc_id the smallest
counts, and of several texts the first in order; ties among neighbours go to the earlier sample row; extra columns, whatever
their names, pass through kept().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WHITE_SPACE, encoded, groups_of, mixed, unused, word_hashes, word_table

#: Labelled rows of each label value that the classifier is fitted on, at most.
SAMPLE_ROWS = {0: 2048, 1: 4096}
THRESHOLD = 0.3
GRAMS, LATENT = 1024, 64
NEIGHBOURS, SHARPNESS = 24, 8.0
HELD_OUT_OF = 5
BATCH_BYTES = 1 << 20
SHARES = 10
SHARE_WEIGHT = 0.35

_IS_WORD = word_table(WHITE_SPACE)


def _classes() -> np.ndarray:
    """Class of each byte: lower case, capitals, digits, blanks, line ends, non-ASCII, and each mark its own."""
    kind = np.arange(256, dtype=np.uint32)
    for chars, to in ((range(97, 123), 97), (range(65, 91), 65), (range(48, 58), 48), ((9, 11, 12, 32), 32), ((10, 13), 10), (range(128, 256), 97)):
        kind[list(chars)] = to
    return kind


_CLASS = _classes()


def features(texts: list[bytes]) -> np.ndarray:
    """Gram counts and shares of whole texts, one row each (float32)."""
    out = np.zeros((len(texts), GRAMS + SHARES), np.float32)
    for i, text in enumerate(texts):
        for at in range(0, len(text), BATCH_BYTES):  # pieces overlap by three bytes, so that no gram is lost
            c = _CLASS[np.frombuffer(text, np.uint8, min(len(text) - at, BATCH_BYTES + 3), at)]
            if len(c) >= 4:
                g = ((c[:-3] * np.uint32(0x9E3779B1)) ^ (c[1:-2] * np.uint32(0x85EBCA77)) ^ (c[2:-1] * np.uint32(0xC2B2AE3D)) ^ (c[3:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
                out[i, :GRAMS] += np.bincount(g >> np.uint32(22), minlength=GRAMS)
    words, at = word_hashes(texts, _IS_WORD)
    with np.errstate(over="ignore"):
        triples = mixed(words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] * np.uint64(7)) if len(words) > 2 else words[:0]
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        n, size = b - a, len(texts[i])
        if not n:
            continue
        text, own = texts[i], words[a:b]
        three = triples[a : max(a, b - 2)]
        raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        marks = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()
        out[i, GRAMS:] = (
            (own[1:] == own[:-1]).mean() if n > 1 else 0.0,
            1 - len(np.unique(three)) / len(three) if len(three) else 0.0,
            len(np.unique(own)) / n,
            raw[65:91].sum() / size,
            marks / size,
            raw[48:58].sum() / size,
            raw[124] / n,
            raw[33] / n,
            min(1.0, (size - n) / n / 16),
            min(1.0, raw[10] / n * 8),
        )
    return out


class Model:
    """The latent space and the labelled vectors in it."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, population: dict[int, int]) -> None:
        self.labels = labels.astype(np.float32)
        grams = np.log1p(x[:, :GRAMS])
        self.idf = (np.log((1 + len(x)) / (1 + (grams > 0).sum(0))) + 1).astype(np.float32)
        full = self._weighted(x)
        self.basis = np.linalg.eigh(full.T @ full)[1][:, ::-1][:, :LATENT].astype(np.float32) if len(x) else np.zeros((GRAMS + SHARES, 1), np.float32)
        self.vectors = self._unit(full @ self.basis)
        n = {k: max(1, int((labels == k).sum())) for k in (0, 1)}
        self.weight = np.array([population.get(int(k), 0) / n[int(k)] for k in labels], np.float32)

    def _weighted(self, x: np.ndarray) -> np.ndarray:
        grams = self._unit(np.log1p(x[:, :GRAMS]) * self.idf)
        return np.concatenate([grams, SHARE_WEIGHT * np.sqrt(np.maximum(x[:, GRAMS:], 0))], 1)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        size = np.sqrt((x * x).sum(1, keepdims=True))
        return x / np.where(size > 0, size, 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.vectors):
            return np.ones(len(texts))
        x = features(texts)
        out = np.zeros(len(texts))
        k = min(NEIGHBOURS, len(self.vectors))
        for i in range(0, len(x), 256):
            v = self._unit(self._weighted(x[i : i + 256]) @ self.basis)
            cosine = v @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** SHARPNESS * self.weight[near]
            total = vote.sum(1)
            out[i : i + 256] = np.where(total > 0, (vote * self.labels[near]).sum(1) / np.where(total > 0, total, 1), 0)
        out[[not t.strip() for t in texts]] = 0
        return np.clip(out, 0, 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from a sample of the labelled rows that are not held out, at most SAMPLE_ROWS of each value."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1) and doc_id is not null")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    population = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value, most in SAMPLE_ROWS.items():
        part = known.filter(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in groups_of(pc.binary_length(batch.column(2)).fill_null(0).to_pylist(), BATCH_BYTES):
                part = batch.slice(a, b - a)
                x = features(encoded(part.column(2).to_pylist(), lower=False)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "quality", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # one text for each doc_id of the sample
    got = rows.select("doc_id", "quality", "text").mapInArrow(measure, "doc_id long, quality int, x binary").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, GRAMS + SHARES)
    return Model(x, got["quality"].to_numpy(), population)


def scored(docs: DataFrame, model: Model, name: str = "__score") -> DataFrame:
    """docs with a further column of that name, the probability of label 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = next(i for i, n in enumerate(names) if n == "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in groups_of(pc.binary_length(batch.column(at)).fill_null(0).to_pylist(), BATCH_BYTES):
                part = batch.slice(a, b - a)
                s = held.value.scores(encoded(part.column(at).to_pylist(), lower=False))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], [*names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are not rejected, with their columns."""
    (name,) = unused(docs, "score")
    return scored(docs, fit(docs, labels), name).filter(F.col(name) >= threshold).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
