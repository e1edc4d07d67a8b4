"""Text models with Spark ML: TF-IDF features and a class-weighted linear classifier."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, IDFModel, Normalizer, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import CLASSIFIER_TOKEN, grams, tokens, without
from tidemark.operators import metrics
from tidemark.operators.guards import require
from tidemark.operators.tfidf import Corpus


@dataclass
class TextFeatures:
    """Fitted vocabulary and idf: 1 + ln(tf) times ln((1 + n) / (1 + df)) + 1 at unit length.

    idf is Spark's plus one, so that a term of all documents still counts.
    """

    counts: object
    idf: object
    pattern: str
    ngram_max: int
    stop: list[str]

    @property
    def vocabulary(self) -> list[str]:
        return self.counts.vocabulary

    def terms(self, df: DataFrame, text_col: str) -> DataFrame:
        words = without(tokens(F.col(text_col), self.pattern), self.stop)
        return df.withColumn("__words", words).withColumn("__terms", grams(F.col("__words"), self.ngram_max)).drop("__words")

    def transform(self, df: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
        """df (or its columns keep) with features: counts become weights in Arrow batches, over the values of all rows of a batch."""
        counted = self.counts.transform(self.terms(df, text_col)).select(*(df.columns if keep is None else keep), F.col("__counts").alias("features"))
        idf = df.sparkSession.sparkContext.broadcast(self.idf.idf.toArray() + 1.0)
        at = len(counted.columns) - 1

        def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = batch.column(at)
                fields = [vectors.field(i) for i in range(4)]  # kind, size, indices, values of sparse vectors
                index, value = (np.asarray(fields[i].flatten().to_numpy(zero_copy_only=False)) for i in (2, 3))
                w = (1.0 + np.log(value)) * idf.value[index]
                row = np.repeat(np.arange(batch.num_rows), fields[3].value_lengths().to_numpy(zero_copy_only=False))
                size = np.sqrt(np.bincount(row, weights=w * w, minlength=batch.num_rows))
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
                fields[3] = pa.ListArray.from_arrays(pa.array(ends), pa.array(w / size[row]), type=fields[3].type)
                yield batch.set_column(at, batch.schema.field(at), pa.StructArray.from_arrays(fields, fields=list(vectors.type)))

        return counted.mapInArrow(weighted, counted.schema)

    def save(self, spark: SparkSession, path: str, overwrite: bool = False) -> None:
        """Vocabulary, idf and settings under path."""
        save(self.counts, f"{path}/counts", overwrite)
        save(self.idf, f"{path}/idf", overwrite)
        said = json.dumps({"pattern": self.pattern, "ngram_max": self.ngram_max, "stop": self.stop})
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").text(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TextFeatures":
        said = json.loads(spark.read.text(f"{path}/settings").first().value)
        return TextFeatures(CountVectorizerModel.load(f"{path}/counts"), IDFModel.load(f"{path}/idf"), said["pattern"], said["ngram_max"], said["stop"])


def fit_features(train: DataFrame, text_col: str, *, min_df: int = 3, max_df: float = 1.0, max_features: int = 50_000, ngram_max: int = 2, pattern: str = CLASSIFIER_TOKEN, stop: list[str] | None = None) -> TextFeatures:
    corpus = Corpus(train, None, text_col, pattern, ngram_max, stop)
    terms = corpus.vocabulary(min_df, max_df if max_df < 1 else 1.0, max_features).toArrow()  # at most max_features rows
    require(terms.num_rows > 0, "no term passes the limits of the vocabulary")
    counts = CountVectorizerModel.from_vocabulary(terms["term"].to_pylist(), inputCol="__terms", outputCol="__counts")
    return TextFeatures(counts, _idf_model(train.sparkSession, terms["df"].to_pylist(), corpus.rows), pattern, ngram_max, stop or [])


def _idf_model(spark: SparkSession, df: list[int], rows: int) -> IDFModel:
    """Spark's model of known document frequencies: ln((1 + rows) / (1 + df))."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    values, counts = gateway.new_array(jvm.double, len(df)), gateway.new_array(jvm.long, len(df))
    for i, n in enumerate(df):
        values[i], counts[i] = float(np.log((1 + rows) / (1 + n))), n
    fitted = jvm.org.apache.spark.mllib.feature.IDFModel(jvm.org.apache.spark.mllib.linalg.DenseVector(values), counts, rows)
    model = IDFModel(jvm.org.apache.spark.ml.feature.IDFModel(f"IDF_{uuid.uuid4().hex[:12]}", fitted))
    return model.setInputCol("__counts").setOutputCol("__idf")


def weighted_rows(df: DataFrame, label_col: str) -> tuple[DataFrame, int, int]:
    """df with weight = n / (classes * rows of the class)."""
    per = df.groupBy(label_col).agg(F.count("*").alias("__n"))
    n, k = df.count(), per.count()
    return df.join(F.broadcast(per), label_col).withColumn("weight", F.lit(float(n)) / (F.lit(k) * F.col("__n"))).drop("__n"), n, k


def fit_classifier(df: DataFrame, label_col: str, *, c: float = 1.0, max_iterations: int = 250) -> PipelineModel:
    """Multinomial logistic regression with balanced classes over features; c is the inverse of the penalty."""
    require(c > 0, "C must be positive")
    rows, n, _ = weighted_rows(df, label_col)
    index = StringIndexer(inputCol=label_col, outputCol="__label", stringOrderType="alphabetAsc")
    fit = LogisticRegression(featuresCol="features", labelCol="__label", weightCol="weight", family="multinomial", maxIter=max_iterations, regParam=1.0 / (c * n), standardization=False)
    return Pipeline(stages=[index, fit]).fit(rows)


def classes_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def predict(model: PipelineModel, df: DataFrame, label_col: str, keep: list[str] | None = None) -> DataFrame:
    """keep, truth, prediction, probability (array) of every row."""
    names = F.array(*map(F.lit, classes_of(model)))
    out = model.stages[1].transform(df)
    return out.select(*(keep or []), F.col(label_col).alias("truth"), F.element_at(names, F.col("prediction").cast("int") + 1).alias("prediction"), vector_to_array("probability").alias("probability"))


def train(train_rows: DataFrame, validation: DataFrame, test: DataFrame, *, text_col: str, label_col: str, candidates: list[float], max_iterations: int = 250, **fit) -> dict:
    """Chooses C on the validation rows, fits again on both, and evaluates once on the test rows.

    The first candidate of the greatest (macro F1, weighted F1) wins.
    """
    features = fit_features(train_rows, text_col, **fit)
    own, held = features.transform(train_rows, text_col, [label_col]).cache(), features.transform(validation, text_col, [label_col]).cache()
    tried = []
    for c in candidates:
        model = fit_classifier(own, label_col, c=c, max_iterations=max_iterations)
        row = metrics.summary(metrics.confusion(predict(model, held, label_col))).first()
        tried.append({"c": c, "iterations": model.stages[1].summary.totalIterations, **row.asDict()})
    best = max(tried, key=lambda x: (x["macro_f1"], x["weighted_f1"]))  # the first of equals
    own.unpersist()
    held.unpersist()
    both = train_rows.unionByName(validation, allowMissingColumns=True)
    features = fit_features(both, text_col, **fit)
    rows = features.transform(both, text_col, [label_col]).cache()
    model = fit_classifier(rows, label_col, c=best["c"], max_iterations=max_iterations)
    rows.unpersist()
    predictions = predict(model, features.transform(test, text_col, [label_col]), label_col)
    return {"features": features, "model": model, "candidates": tried, "chosen": best["c"], "predictions": predictions, "classes": classes_of(model)}


def unit(df: DataFrame, array_col: str) -> DataFrame:
    """df with features: the array as a vector of unit length."""
    rows = df.withColumn("__raw", array_to_vector(F.transform(F.col(array_col), lambda x: x.cast("double"))))
    return Normalizer(p=2.0, inputCol="__raw", outputCol="features").transform(rows).drop("__raw")


def save(model, path: str, overwrite: bool = False) -> None:
    (model.write().overwrite() if overwrite else model.write()).save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_text_model(spark: SparkSession, features: TextFeatures, model: PipelineModel, path: str, overwrite: bool = False) -> None:
    """Features and model, so that texts can be scored from the artifact alone."""
    features.save(spark, f"{path}/features", overwrite)
    save(model, f"{path}/model", overwrite)


def load_text_model(spark: SparkSession, path: str) -> tuple[TextFeatures, PipelineModel]:
    return TextFeatures.load(spark, f"{path}/features"), load(f"{path}/model")
