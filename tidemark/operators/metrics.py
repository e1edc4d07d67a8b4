"""Classification and calibration metrics as aggregates over (truth, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.guards import require


def labels_of(*tables: DataFrame, label_col: str = "truth") -> DataFrame:
    """The sorted distinct labels of several tables, as actual."""
    out = tables[0].select(F.col(label_col).alias("actual"))
    for t in tables[1:]:
        out = out.union(t.select(F.col(label_col).alias("actual")))
    return out.distinct().orderBy("actual")


def confusion(predictions: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """actual, predicted, n for every pair of labels, zeros included."""
    counts = predictions.groupBy(F.col("truth").alias("actual"), F.col("prediction").alias("predicted")).agg(F.count("*").alias("n"))
    names = labels if labels is not None else counts.select("actual").union(counts.select("predicted")).distinct()
    cells = names.select("actual").crossJoin(F.broadcast(names.select(F.col("actual").alias("predicted"))))
    return cells.join(counts, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def normalised(matrix: DataFrame) -> DataFrame:
    """actual, predicted, share of the actual row; an empty row has zeros."""
    row = F.sum("n").over(Window.partitionBy("actual"))
    return matrix.select("actual", "predicted", (F.col("n") / F.greatest(row, F.lit(1))).alias("share"))


def _safe(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def per_class(matrix: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support, predicted_rows; a zero denominator gives 0."""
    both = matrix.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).cast("long").alias("hit")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p"), F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    sums = both.groupBy("label").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted_rows"), F.sum("hit").alias("hit"))
    sums = sums.withColumns({"precision": _safe(F.col("hit"), F.col("predicted_rows")), "recall": _safe(F.col("hit"), F.col("support"))})
    f1 = _safe(2 * F.col("hit").cast("double"), F.col("support") + F.col("predicted_rows"))
    return sums.select("label", "precision", "recall", f1.alias("f1"), "support", "predicted_rows")


def summary(matrix: DataFrame) -> DataFrame:
    """accuracy, balanced_accuracy, macro_f1, weighted_f1, rounded to 6 places.

    Balanced accuracy averages recall over the true classes; macro F1 averages
    over classes that occur as truth or prediction.
    """
    c = per_class(matrix)
    true, met = F.col("support") > 0, (F.col("support") > 0) | (F.col("predicted_rows") > 0)
    return c.agg(
        F.round(F.sum(F.col("recall") * F.col("support")) / F.sum("support"), 6).alias("accuracy"),
        F.round(F.avg(F.when(true, F.col("recall"))), 6).alias("balanced_accuracy"),
        F.round(F.avg(F.when(met, F.col("f1"))), 6).alias("macro_f1"),
        F.round(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), 6).alias("weighted_f1"),
    )


def majority(train: DataFrame, label_col: str = "truth") -> DataFrame:
    """label: the most frequent training label, ties by label."""
    return train.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(1).select("label")


def majority_predictions(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """truth and the training majority as prediction."""
    return evaluation.select("truth").crossJoin(F.broadcast(majority(train).withColumnRenamed("label", "prediction")))


def top_confusions(matrix: DataFrame, most: int = 15) -> DataFrame:
    """actual, predicted, n, share_of_actual_pct of the largest cells off the diagonal, ties by label."""
    row = F.sum("n").over(Window.partitionBy("actual"))
    cells = matrix.withColumn("__row", row).filter("actual <> predicted and n > 0")
    return cells.orderBy(F.desc("n"), "actual", "predicted").limit(most).select("actual", "predicted", "n", F.round(100.0 * F.col("n") / F.col("__row"), 2).alias("share_of_actual_pct"))


def _edges(bins: int) -> list[float]:
    return [i * (1.0 / bins) if i < bins else 1.0 for i in range(bins + 1)]


def _bin(edges: list[float]) -> Column:
    """Number of edges but the outer ones that confidence reaches: its bin, the last one closed."""
    inner = F.array(*map(F.lit, edges[1:-1]))
    return F.size(F.filter(inner, lambda e: e <= F.col("confidence")))


def judged(predictions: DataFrame, classes: list[str]) -> DataFrame:
    """truth, probability, confidence, predicted (ties to the first class), correct."""
    p = F.col("probability")
    best = F.element_at(F.array(*map(F.lit, classes)), F.array_position(p, F.array_max(p)).cast("int"))
    rows = predictions.select("truth", "probability", F.array_max(p).alias("confidence"), best.alias("predicted"))
    return rows.withColumn("correct", F.col("predicted") == F.col("truth"))


def calibration_bins(predictions: DataFrame, classes: list[str], bins: int = 10) -> DataFrame:
    """bin, lower, upper, n, mean_confidence, accuracy of equal bins [lower, upper), the last closed; empty ones included."""
    require(bins > 0, "bins must be positive")
    edges = _edges(bins)
    counts = judged(predictions, classes).groupBy(_bin(edges).alias("bin")).agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg(F.col("correct").cast("double")).alias("accuracy"))
    spark = predictions.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    of = lambda k: F.element_at(F.array(*map(F.lit, edges)), F.col("bin") + F.lit(k))
    out = all_bins.join(F.broadcast(counts), "bin", "left")
    return out.select("bin", F.round(of(1), 2).alias("lower"), F.round(of(2), 2).alias("upper"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.round("mean_confidence", 6).alias("mean_confidence"), F.round("accuracy", 6).alias("accuracy"))


def calibration_summary(predictions: DataFrame, classes: list[str], bins: int = 10) -> DataFrame:
    """ECE, log loss, Brier score (summed over classes) and mean confidences, rounded to 6 places."""
    require(bins > 0, "bins must be positive")
    edges = _edges(bins)
    rows = judged(predictions, classes)
    names = F.array(*map(F.lit, classes))
    own = F.element_at("probability", F.array_position(names, F.col("truth")).cast("int"))
    squares = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.select(_bin(edges).alias("bin"), "confidence", "correct", F.least(F.greatest(own, F.lit(2.220446049250313e-16)), F.lit(1 - 2.220446049250313e-16)).alias("own"), (squares - 2 * own + 1).alias("brier"))
    per_bin = rows.groupBy("bin").agg(
        F.count("*").alias("n"),
        F.sum("confidence").alias("conf"),
        F.count_if("correct").alias("hits"),
        F.sum(F.when(F.col("correct"), F.col("confidence"))).alias("conf_hit"),
        F.sum(-F.log("own")).alias("loss"),
        F.sum("brier").alias("brier"),
    )
    total = F.sum("n")
    return per_bin.agg(
        F.round(F.sum(F.abs(F.col("hits") - F.col("conf"))) / total, 6).alias("expected_calibration_error"),
        F.round(F.sum("loss") / total, 6).alias("multiclass_log_loss"),
        F.round(F.sum("brier") / total, 6).alias("multiclass_brier_score"),
        F.round(F.sum("conf") / total, 6).alias("mean_confidence"),
        F.round(F.try_divide(F.sum("conf_hit"), F.sum("hits")), 6).alias("mean_confidence_correct"),
        F.round(F.try_divide(F.sum("conf") - F.coalesce(F.sum("conf_hit"), F.lit(0.0)), total - F.sum("hits")), 6).alias("mean_confidence_incorrect"),
    )
