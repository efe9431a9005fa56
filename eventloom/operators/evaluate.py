"""Ensembles, ranking metrics, error metrics and threshold tables.

Ranking metrics work on one row per distinct score, with running sums that are safe for any number
of distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import Ordered, ordered_columns

CRITERIA = ("accuracy", "precision", "recall", "min_per_class_accuracy")


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def arithmetic_mean(names: Sequence[str]) -> Column:
    return sum(_cols(names[1:]), F.col(names[0])) / F.lit(len(names))


def geometric_mean(names: Sequence[str]) -> Column:
    product = F.col(names[0])
    for c in _cols(names[1:]):
        product = product * c
    return F.sqrt(product) if len(names) == 2 else F.pow(product, F.lit(1.0 / len(names)))


def harmonic_mean(names: Sequence[str]) -> Column:
    inverse = F.lit(1.0) / F.col(names[0])
    for c in _cols(names[1:]):
        inverse = inverse + F.lit(1.0) / c
    return F.lit(float(len(names))) / inverse


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.sum(F.col(label).cast("bigint"))
    return df.groupBy(F.col(score).alias("score")).agg(
        positive.alias("pos"), (F.count(F.lit(1)) - positive).alias("neg")
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve from the rank sum, ties counted half."""
    return auc_of(df, label, [score]).select("auc")


def auc_of(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """:func:`auc` of several score columns (``model``, ``auc``), from one pass over ``df``.

    The scores are laid out as rows and counted per distinct value before anything is sorted; the running sum then
    has the model as its key.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("score")) for c in scores]))
    rows = df.select(F.col(label).cast("bigint").alias("__y"), cells.alias("__cell")).select("__y", "__cell.*")
    counted = rows.groupBy("model", "score").agg(
        F.sum("__y").alias("pos"), (F.count(F.lit(1)) - F.sum("__y")).alias("neg")
    )
    counts = ordered_columns(counted, ["model"], ["score"], [Ordered("running_sum", "upto", "neg")])
    below = F.col("upto") - F.col("neg")
    wins = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return counts.groupBy("model").agg((wins / pairs).alias("auc"))


def log_loss_value(label: str, score: str) -> Column:
    y, p = F.col(label), F.col(score)
    return -F.avg(y * F.log(p) + (F.lit(1) - y) * F.log(F.lit(1) - p))


def log_loss(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.agg(log_loss_value(label, score).alias("logloss"))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    predicted = (F.col(score) > F.lit(threshold)).cast("int").alias("pred")
    return df.groupBy(predicted, F.col(label).alias("true")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    hit = ((F.col(score) > F.lit(threshold)).cast("int") == F.col(label)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def summary(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """MSE, RMSE, R2, log-loss, mean per-class error, AUC and Gini in one row."""
    y, p = F.col(label), F.col(score)
    squared = (y - p) * (y - p)
    wrong = ((p > F.lit(threshold)).cast("int") != y).cast("double")
    errors = df.agg(
        F.avg(squared).alias("mse"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        (F.lit(1) - F.avg(squared) / F.var_pop(y)).alias("r2"),
        log_loss_value(label, score).alias("logloss"),
        ((F.avg(F.when(y == 1, wrong)) + F.avg(F.when(y == 0, wrong))) / 2).alias("mean_per_class_error"),
    )
    ranking = auc(df, label, score).withColumn("gini", 2 * F.col("auc") - 1)
    # both sides are one row: keyed on a constant, so the join stays a hash join
    one = F.lit(1).alias("__one")
    return errors.select(one, "*").join(F.broadcast(ranking.select(one, "*")), "__one").drop("__one")


def thresholds(df: DataFrame, label: str, score: str) -> DataFrame:
    """Accuracy, precision, recall and smallest per-class accuracy when predicting ``score >= threshold``,
    for every distinct score."""
    counts = score_counts(df, label, score)
    totals = counts.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    steps = [Ordered("running_sum", "tp", "pos"), Ordered("running_sum", "fp", "neg")]
    running = ordered_columns(counts, [], [F.col("score").desc()], steps)
    one = F.lit(1).alias("__one")
    joined = running.select(one, "*").join(F.broadcast(totals.select(one, "*")), "__one")
    tp, fp, p, n = F.col("tp"), F.col("fp"), F.col("all_pos"), F.col("all_neg")
    tn = n - fp
    return joined.select(
        F.col("score").alias("threshold"),
        ((tp + tn) / (p + n)).alias("accuracy"),
        (tp / (tp + fp)).alias("precision"),
        (tp / p).alias("recall"),
        F.least(tp / p, tn / n).alias("min_per_class_accuracy"),
    )


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per (ids, variable)."""
    return df.unpivot(list(ids), list(values), "variable", "value")


def max_criteria(df: DataFrame, label: str, score: str) -> DataFrame:
    """Best value of each criterion and the (largest) threshold that reaches it."""
    long = to_long(thresholds(df, label, score), ["threshold"], CRITERIA)
    best = F.max(F.struct("value", "threshold"))
    return (
        long.groupBy(F.col("variable").alias("criterion"))
        .agg(best.alias("best"))
        .select("criterion", F.col("best.threshold").alias("threshold"), F.col("best.value").alias("value"))
    )
