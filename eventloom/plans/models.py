"""Distributed classifiers, ensembles and searches with pyspark.ml.

Every function takes frames with numeric feature columns and a 0/1 label and returns frames or
small result tables; fitted models stay available where a caller needs them. Scores are always the
probability of class 1.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    TargetEncoder,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.evaluate import auc_of
from eventloom.operators.ordered import TASK_ROWS
from eventloom.operators.relational import param_grid
from eventloom.operators.sampling import balance, fold_modulo, split_bernoulli, token, uniform

FEATURES = "__features"
SCORE = "p"


#: Partitions of a frame that is kept for a fit, unless its rows ask for more.
FIT_PARTITIONS = 16


@contextmanager
def held(*frames: DataFrame):
    """Keep the frames of an iterative fit in executor memory or on executor disk meanwhile.

    Every task of every pass reports to the driver. A kept frame has all partitions of the shuffle that made it, however few
    rows they hold, so they are united to ``FIT_PARTITIONS``, or to one for ``TASK_ROWS`` rows if that is more.
    """
    kept = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        united = [_united(f) for f in kept]
        yield united if len(united) > 1 else united[0]
    finally:
        for f in kept:
            f.unpersist()


def _united(kept: DataFrame) -> DataFrame:
    most = max(FIT_PARTITIONS, -(-kept.count() // TASK_ROWS))
    # Uniting into as many would still change their order, and with it what a sampling learner draws.
    return kept.coalesce(most) if kept.rdd.getNumPartitions() > most else kept


def assembler(features: Sequence[str], missing: str = "keep") -> VectorAssembler:
    """``missing`` says what a NULL or NaN does: ``keep`` it as NaN (trees only) or ``skip`` the row."""
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid=missing)


def _numeric_stages(features: Sequence[str], missing: str) -> list:
    """Assembling stages for models that need numbers: ``mean`` fills in the training mean, so that every row
    gets a score; ``skip`` leaves rows with a missing value out of the fit and of the scores."""
    if missing == "skip":
        return [assembler(features, "skip")]
    if missing != "mean":
        raise ValueError(f"missing must be 'mean' or 'skip', not {missing!r}")
    filled = [f"__filled_{f}" for f in features]
    return [Imputer(inputCols=list(features), outputCols=filled, strategy="mean"), assembler(filled, "skip")]


#: Levels that a declared categorical column of a tree may have.
TREE_LEVELS = 1000


def level_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Distinct values of each column, in one pass."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    return {c: int(row[c]) for c in columns}


def _tree_stages(features: Sequence[str], categorical: dict[str, int], encode: Sequence[str], label: str) -> tuple[list, int]:
    """Assembling stages of trees with declared categorical columns, and the bins that they need.

    ``categorical`` maps columns to their levels in the training data (:func:`level_counts`): their values are indexed
    and marked as nominal, and values not seen in training share one more level. Columns in ``encode`` are replaced by
    the smoothed mean of the label per value, fitted on the training data; a column with
    more than ``TREE_LEVELS`` levels must be among them.
    """
    large = [c for c, n in categorical.items() if n > TREE_LEVELS and c not in encode]
    if large:
        raise ValueError(f"{large} have more than {TREE_LEVELS} levels: name them in encode")
    nominal = [c for c in features if c in categorical and c not in encode]
    encoded = [c for c in features if c in encode]
    names = {c: f"__level_{c}" for c in [*nominal, *encoded]}
    stages: list = []
    if nominal or encoded:
        both = [*nominal, *encoded]
        stages.append(StringIndexer(inputCols=both, outputCols=[names[c] for c in both], handleInvalid="keep"))
    if encoded:
        stages.append(
            TargetEncoder(
                inputCols=[names[c] for c in encoded],
                outputCols=[f"__mean_of_{c}" for c in encoded],
                labelCol=label,
                targetType="binary",
                smoothing=20.0,
                handleInvalid="keep",
            )
        )
        # The encoder's columns are still marked as nominal; a sum is a plain number.
        plain = ", ".join(f"`__mean_of_{c}` + 0.0D AS `__mean_{c}`" for c in encoded)
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
        names |= {c: f"__mean_{c}" for c in encoded}
    stages.append(assembler([names.get(f, f) for f in features]))
    return stages, max([categorical[c] + 1 for c in nominal], default=0)


def with_score(df: DataFrame, name: str = SCORE) -> DataFrame:
    """P(class 1) as a plain column instead of the model output columns."""
    scored = df.withColumn(name, vector_to_array("probability")[1])
    made = [c for c in scored.columns if c.startswith(("__filled_", "__level_", "__mean_"))]
    return scored.drop("rawPrediction", "probability", "prediction", FEATURES, "__scaled", *made)


# --- single models: unfitted pipelines ----------------------------------------------------------------


def gbt(
    features: Sequence[str],
    label: str,
    rounds: int = 20,
    depth: int = 3,
    step: float = 0.1,
    bins: int = 100,
    subsample: float = 0.7,
    weight: str | None = None,
    validation: str | None = None,
    seed: int = 1,
    categorical: dict[str, int] | None = None,
    encode: Sequence[str] = (),
) -> Pipeline:
    """Boosted trees; ``validation`` names a boolean column whose rows stop the boosting early. ``categorical`` and
    ``encode`` declare columns whose values have no order, see :func:`_tree_stages`."""
    stages, needed = _tree_stages(features, categorical or {}, encode, label)
    tree = GBTClassifier(
        featuresCol=FEATURES, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, maxBins=max(bins, needed),
        subsamplingRate=subsample, seed=seed, validationTol=0.001,
    )
    if weight:
        tree = tree.setWeightCol(weight)
    if validation:
        tree = tree.setValidationIndicatorCol(validation)
    return Pipeline(stages=[*stages, tree])


def random_forest(
    features: Sequence[str],
    label: str,
    trees: int = 50,
    depth: int = 5,
    seed: int = 1,
    bins: int = 32,
    categorical: dict[str, int] | None = None,
    encode: Sequence[str] = (),
    bootstrap: bool = True,
) -> Pipeline:
    """A forest; ``categorical`` and ``encode`` as in :func:`gbt`. Without ``bootstrap`` all trees see all rows and columns."""
    stages, needed = _tree_stages(features, categorical or {}, encode, label)
    forest = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, maxBins=max(bins, needed),
        bootstrap=bootstrap, featureSubsetStrategy="auto" if bootstrap else "all",
    )
    return Pipeline(stages=[*stages, forest])


def logistic(
    features: Sequence[str], label: str, alpha: float = 0.5, reg: float = 1e-5, rounds: int = 50, missing: str = "mean"
) -> Pipeline:
    """Logistic regression with elastic net (``alpha`` 1 is LASSO); ``missing`` as in :func:`_numeric_stages`."""
    model = LogisticRegression(
        featuresCol=FEATURES, labelCol=label, elasticNetParam=alpha, regParam=reg, maxIter=rounds, standardization=True
    )
    return Pipeline(stages=[*_numeric_stages(features, missing), model])


def perceptron(
    features: Sequence[str], label: str, hidden: Sequence[int] = (200, 200), rounds: int = 50, seed: int = 1,
    missing: str = "mean",
) -> Pipeline:
    """Feed-forward network on standardised features; ``missing`` as in :func:`_numeric_stages`."""
    scaler = StandardScaler(inputCol=FEATURES, outputCol="__scaled", withMean=True)
    net = MultilayerPerceptronClassifier(
        featuresCol="__scaled", labelCol=label, layers=[len(features), *hidden, 2], maxIter=rounds, seed=seed
    )
    return Pipeline(stages=[*_numeric_stages(features, missing), scaler, net])


def fit_score(estimator: Estimator, train: DataFrame, test: DataFrame, name: str = SCORE) -> DataFrame:
    """Fit on ``train`` and return ``test`` with the score column."""
    with held(train) as kept:
        fitted = estimator.fit(kept)
    return with_score(fitted.transform(test), name)


def model_auc(fitted: Model, df: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(labelCol=label).evaluate(fitted.transform(df))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def balanced_fit(estimator: Estimator, train: DataFrame, key: str, label: str, seed: int = 1) -> PipelineModel:
    """Fit after under-sampling the classes to equal size."""
    with held(balance(train, key, label, seed)) as kept:
        return estimator.fit(kept)


# --- encodings --------------------------------------------------------------------------------------


def one_hot(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, name: str = "onehot") -> DataFrame:
    """Dummy columns of all ``columns`` side by side, as an array; ``fit_on`` may be train and test together."""
    indexes, vectors = [f"__i_{c}" for c in columns], [f"__v_{c}" for c in columns]
    steps = Pipeline(
        stages=[
            StringIndexer(inputCols=list(columns), outputCols=indexes, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexes, outputCols=vectors),
            VectorAssembler(inputCols=vectors, outputCol="__onehot"),
        ]
    )
    fitted = steps.fit(df if fit_on is None else fit_on)
    return fitted.transform(df).withColumn(name, vector_to_array("__onehot")).drop(*indexes, *vectors, "__onehot")


def dummies(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """A 0/1 column for each value of each column but the first value, and their names.

    Values are those of ``fit_on`` (by default of ``df``) in order; a NULL, or a value not among them, has zeros. At most
    ``TREE_LEVELS`` values of a column become columns, more are refused.
    """
    source, made = df if fit_on is None else fit_on, {}
    for c in columns:
        values = [r[0] for r in source.select(c).distinct().where(F.col(c).isNotNull()).limit(TREE_LEVELS + 1).collect()]
        if len(values) > TREE_LEVELS:
            raise ValueError(f"{c} has more than {TREE_LEVELS} values")
        for value in sorted(values)[1:]:
            name = f"{c}_" + re.sub(r"\W+", "_", str(value)).strip("_")
            made[name] = F.coalesce(F.col(c) == F.lit(value), F.lit(False)).cast("double")
    return df.withColumns(made), list(made)


# --- cross-validation, search, leaderboard --------------------------------------------------------------


#: Partitions of a frame whose order of rows is fixed, at least.
FIXED_PARTITIONS = 8


def fixed_rows(df: DataFrame, key: str) -> DataFrame:
    """The rows in partitions and an order that depend on ``key`` and the number of rows only, so that a sampling learner draws alike.

    A partition holds about ``TASK_ROWS`` rows, so that a task keeps its size when the table grows.
    """
    return df.repartition(max(FIXED_PARTITIONS, -(-df.count() // TASK_ROWS)), key).sortWithinPartitions(key)


def cross_validate(
    estimator: Estimator, train: DataFrame, label: str, order: Sequence[str], folds: int = 3, parallelism: int = 2
) -> DataFrame:
    """Mean and standard deviation of the AUC over folds assigned by position."""
    numbered = fold_modulo(train, order, folds, "__fold").withColumn("__fold", F.col("__fold").cast("int"))
    with held(fixed_rows(numbered, order[-1])) as kept:
        cv = CrossValidator(
            estimator=estimator, estimatorParamMaps=[{}], evaluator=BinaryClassificationEvaluator(labelCol=label),
            numFolds=folds, foldCol="__fold", parallelism=parallelism,
        ).fit(kept)
    return train.sparkSession.createDataFrame(
        [(folds, float(cv.avgMetrics[0]), float(cv.stdMetrics[0]))], "folds int, auc_mean double, auc_sd double"
    )


def _grid(estimator: Pipeline, values: dict[str, Sequence]):
    stage, builder = estimator.getStages()[-1], ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(stage.getParam(name), list(options))
    return builder.build()


def _settings(param_map) -> str:
    return ",".join(f"{p.name}={v}" for p, v in sorted(param_map.items(), key=lambda kv: kv[0].name))


def _search(estimator: Pipeline, maps: list, train: DataFrame, label: str, key: str, share: float) -> DataFrame:
    """Fit every setting on one hash split of the rows and score it on the other part."""
    parts = split_bernoulli(train, key, share, name="__fit")
    with held(fixed_rows(parts, key)) as kept:
        fit_on, score_on = kept.where("__fit"), kept.where("NOT __fit")
        rows = [(_settings(m), float(model_auc(estimator.fit(fit_on, m), score_on, label))) for m in maps]
    return train.sparkSession.createDataFrame(rows, "settings string, auc double").orderBy(F.desc("auc"), "settings")


def grid_search(
    estimator: Pipeline, values: dict[str, Sequence], train: DataFrame, label: str, key: str, share: float = 0.75
) -> DataFrame:
    """Validation AUC of every combination of parameter values of the last stage, best first. ``key`` is
    unique; its hash decides which rows are fitted on."""
    return _search(estimator, _grid(estimator, values), train, label, key, share)


def random_search(
    estimator: Pipeline, values: dict[str, Sequence], train: DataFrame, label: str, key: str, models: int, seed: int = 1,
    share: float = 0.75,
) -> DataFrame:
    """:func:`grid_search` over ``models`` combinations drawn from the full grid."""
    stage = estimator.getStages()[-1]
    grid = param_grid(train.sparkSession, values)
    drawn = (
        grid.withColumn("__key", F.concat_ws(",", *values))
        .orderBy(token("__key", seed))
        .limit(models)
        .select(*values)
        .collect()
    )
    maps = [{stage.getParam(name): row[name] for name in values} for row in drawn]
    return _search(estimator, maps, train, label, key, share)


def leaderboard(
    candidates: dict[str, Estimator], train: DataFrame, test: DataFrame, label: str
) -> DataFrame:
    """AUC of each candidate on ``test``, best first."""
    rows = []
    with held(train, test) as (fit_on, score_on):
        for name, estimator in candidates.items():
            rows.append((name, float(model_auc(estimator.fit(fit_on), score_on, label))))
    return train.sparkSession.createDataFrame(rows, "model string, auc double").orderBy(F.desc("auc"), "model")


def race(
    candidates: dict[str, Estimator],
    train: DataFrame,
    test: DataFrame,
    label: str,
    key: str,
    start: float = 0.0625,
    tolerance: float = 0.0,
    seed: int = 1,
) -> DataFrame:
    """A leaderboard by successive halving: ``model``, ``rung``, ``rows`` fitted on, ``auc`` on ``test``; the winner has the last rung.

    All candidates are fitted on a small part of the rows, the better half goes on with twice as many, and so on until one
    is left, which is fitted on all rows, or the whole table is used. Besides the better half those stay whose AUC is within ``tolerance`` of its
    last one. The parts are nested and drawn by the hash of ``key`` (unique), so a rerun races over the same rows; each is a
    filter of the held table, no part is written.
    """
    left, rows, share, rung = dict(candidates), [], min(start, 1.0), 0
    with held(fixed_rows(train, key), test) as (whole, score_on):
        while left:
            rung += 1
            part = whole if share >= 1 else whole.where(uniform(key, seed) < share)
            size = part.count()
            found = [(name, rung, size, float(model_auc(estimator.fit(part), score_on, label))) for name, estimator in left.items()]
            rows += found
            found.sort(key=lambda r: (-r[3], r[0]))
            if len(found) == 1 or share >= 1:
                break
            last = found[(len(found) + 1) // 2 - 1][3]
            left = {r[0]: left[r[0]] for i, r in enumerate(found) if i < (len(found) + 1) // 2 or r[3] >= last - tolerance}
            share = 2 * share if len(left) > 1 else 1.0
    board = train.sparkSession.createDataFrame(rows, "model string, rung int, rows long, auc double")
    return board.orderBy(F.desc("rung"), F.desc("auc"), "model")


@dataclass
class Lasso:
    lambda_min: float
    lambda_1se: float
    coefficients: DataFrame
    errors: list[tuple[float, float, float]]  # value, mean squared error, standard error


def lasso_path(train: DataFrame, features: Sequence[str], label: str, count: int = 10, ratio: float = 0.01) -> list[float]:
    """A falling path of penalties, from the smallest one at which all coefficients vanish to ``ratio`` of it."""
    stats = train.agg(
        *[F.abs(F.covar_pop(F.col(f).cast("double"), F.col(label)) / F.stddev_samp(f)).alias(f) for f in features]
    ).first()
    highest = max(float(stats[f] or 0.0) for f in features) or 1.0
    return [highest * ratio ** (i / (count - 1)) for i in range(count)]


def lasso_cv(
    train: DataFrame, features: Sequence[str], label: str, key: str, regs: Sequence[float] | None = None, folds: int = 3,
    missing: str = "skip",
) -> Lasso:
    """LASSO by cross-validation on the mean squared error of the probability.

    Returns the best penalty of ``regs`` (by default of :func:`lasso_path`), the largest one within one standard error of it
    (deviation over the folds, by the square root of their number), and the non-zero coefficients
    at the latter. Folds are assigned by the hash of ``key``.
    """
    regs = list(lasso_path(train, features, label) if regs is None else regs)
    fold = F.floor(uniform(key, 1) * folds).cast("int")
    rows = complete_rows(train, features) if missing == "skip" else train
    with held(fixed_rows(rows.withColumn("__fold", fold), key)) as kept:
        errors = []
        for reg in regs:
            by_fold = []
            for i in range(folds):
                model = logistic(features, label, alpha=1.0, reg=reg, missing=missing).fit(kept.where(F.col("__fold") != i))
                scored = with_score(model.transform(kept.where(F.col("__fold") == i)))
                by_fold.append(float(scored.agg(F.avg((F.col(label) - F.col(SCORE)) ** 2)).first()[0]))
            errors.append((reg, float(np.mean(by_fold)), float(np.std(by_fold, ddof=1)) / math.sqrt(folds)))
        best = min(errors, key=lambda e: (e[1], -e[0]))
        chosen = max(e[0] for e in errors if e[1] <= best[1] + best[2])
        model = logistic(features, label, alpha=1.0, reg=chosen, missing=missing).fit(kept).stages[-1]
    found = [(f, float(c)) for f, c in zip(features, model.coefficients.toArray()) if c != 0.0]
    kept_features = train.sparkSession.createDataFrame(found, "feature string, coefficient double")
    return Lasso(float(best[0]), float(chosen), kept_features, errors)


# --- ensembles --------------------------------------------------------------------------------------


def stack_out_of_fold(
    bases: dict[str, Estimator], meta: Callable[[Sequence[str]], Estimator], train: DataFrame, test: DataFrame,
    order: Sequence[str], folds: int = 3,
) -> DataFrame:
    """Stacked ensemble: base scores of each fold come from models that did not see it."""
    numbered = fold_modulo(train, order, folds, "__fold")
    with held(numbered, test) as (kept, apply_to):
        out = None
        for fold in range(folds):
            fit_on, score_on = kept.filter(F.col("__fold") != fold), kept.filter(F.col("__fold") == fold)
            for name, estimator in bases.items():
                score_on = with_score(estimator.fit(fit_on).transform(score_on), name)
            out = score_on if out is None else out.unionByName(score_on)
        final = meta(list(bases)).fit(out)
        scored = apply_to
        for name, estimator in bases.items():
            scored = with_score(estimator.fit(kept).transform(scored), name)
    return with_score(final.transform(scored), "ensemble")


def stack_two_stage(
    bases: dict[str, Estimator], meta: Callable[[Sequence[str]], Estimator], first: DataFrame, second: DataFrame,
    test: DataFrame,
) -> DataFrame:
    """Base models fitted on ``first``, the meta model on their scores for ``second``."""
    with held(first, second) as (fit_on, meta_on):
        scored_second, scored_test = meta_on, test
        for name, estimator in bases.items():
            fitted = estimator.fit(fit_on)
            scored_second = with_score(fitted.transform(scored_second), name)
            scored_test = with_score(fitted.transform(scored_test), name)
        final = meta(list(bases)).fit(scored_second)
    return with_score(final.transform(scored_test), "ensemble")


# --- importance, selection, coefficient tables --------------------------------------------------------


def split_counts(fitted: PipelineModel, n_features: int) -> list[int]:
    """How many nodes of all trees split on each feature."""
    counts = [0] * n_features
    for tree in fitted.stages[-1].trees:
        # The printed tree names each split twice, once for either branch.
        for place in re.findall(r"\bIf \(feature (\d+) ", tree.toDebugString):
            counts[int(place)] += 1
    return counts


def importance(spark: SparkSession, fitted: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Gain share per feature in percent, scaled to the largest, and splits on it, best first."""
    gains = fitted.stages[-1].featureImportances.toArray()
    total, top = float(gains.sum()) or 1.0, float(gains.max()) or 1.0
    splits = split_counts(fitted, len(features))
    rows = [(f, 100.0 * float(g) / total, float(g) / top, n) for f, g, n in zip(features, gains, splits)]
    table = spark.createDataFrame(rows, "feature string, gain double, scaled double, splits int")
    return table.orderBy(F.desc("gain"), "feature")


@dataclass
class Selection:
    """The fits on all and on the important features, one row each, and the better model with its features."""

    table: DataFrame
    model: PipelineModel
    features: list[str]


def importance_select(
    build: Callable[[Sequence[str]], Estimator], features: Sequence[str], train: DataFrame, valid: DataFrame, label: str,
    floor: float = 0.05,
) -> Selection:
    """Refit on the features whose scaled importance exceeds ``floor``; the better of both models is kept."""
    spark = train.sparkSession
    with held(train, valid) as (fit_on, score_on):
        full = build(features).fit(fit_on)
        kept = [r["feature"] for r in importance(spark, full, features).filter(F.col("scaled") > floor).collect()]
        small = build(kept).fit(fit_on)
        fits = [
            ("all", list(features), full, float(model_auc(full, score_on, label))),
            ("important", sorted(kept), small, float(model_auc(small, score_on, label))),
        ]
    rows = [(name, len(used), ",".join(used), auc) for name, used, _, auc in fits]
    table = spark.createDataFrame(rows, "fit string, n_features int, features string, auc double")
    better = max(fits, key=lambda f: f[3])
    used = list(features) if better[0] == "all" else kept
    return Selection(table.orderBy(F.desc("auc"), "fit"), better[2], used)


def scoring_history(fitted: PipelineModel, df: DataFrame) -> DataFrame:
    """Loss on ``df`` after each round of fitted boosted trees."""
    staged = PipelineModel(fitted.stages[:-1]).transform(df)
    losses = fitted.stages[-1].evaluateEachIteration(staged)
    rows = [(i + 1, float(x)) for i, x in enumerate(losses)]
    return df.sparkSession.createDataFrame(rows, "round int, loss double")


def staged_margins(fitted: PipelineModel, df: DataFrame, name: str = "margins") -> DataFrame:
    """``df`` with the margin of fitted boosted trees after each round, as an array column, from one pass over the rows.

    Every tree scores a row once; the margin after a round is the running sum of the weighted predictions up to it.
    """
    boosted = fitted.stages[-1]
    staged = PipelineModel(fitted.stages[:-1]).transform(df)
    made = [c for c in staged.columns if c not in df.columns]
    weighted = []
    for i, (tree, weight) in enumerate(zip(boosted.trees, boosted.treeWeights, strict=True)):
        staged = tree.setPredictionCol(f"__tree{i}").transform(staged)
        weighted.append(F.col(f"__tree{i}") * F.lit(float(weight)))
    sums = [weighted[0]]
    for one in weighted[1:]:
        sums.append(sums[-1] + one)
    return staged.withColumn(name, F.array(*sums)).drop(*[f"__tree{i}" for i in range(len(weighted))], *made)


def staged_auc(fitted: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """``round``, ``auc`` on ``df`` of the first trees up to each round: one pass, no model is fitted again."""
    margins = staged_margins(fitted, df)
    rounds = len(fitted.stages[-1].trees)
    columns = [f"r{i + 1}" for i in range(rounds)]
    wide = margins.select(label, *[F.col("margins")[i].alias(c) for i, c in enumerate(columns)])
    return auc_of(wide, label, columns).select(F.substring("model", 2, 10).cast("int").alias("round"), "auc")


def best_round(fitted: PipelineModel, valid: DataFrame, label: str) -> int:
    """The round with the largest AUC on ``valid``, the earliest of equal ones."""
    return staged_auc(fitted, valid, label).orderBy(F.desc("auc"), "round").first()["round"]


def score_at(fitted: PipelineModel, df: DataFrame, round_: int, name: str = SCORE) -> DataFrame:
    """P(class 1) by the first ``round_`` trees."""
    margins = staged_margins(fitted, df, "__margins")
    return margins.withColumn(name, 1 / (1 + F.exp(-2 * F.col("__margins")[round_ - 1]))).drop("__margins")


def coefficient_magnitudes(train: DataFrame, features: Sequence[str], label: str, missing: str = "skip") -> DataFrame:
    """Size of each logistic coefficient on standardised features, largest first."""
    rows = complete_rows(train, features) if missing == "skip" else train
    with held(rows) as kept:
        model = logistic(features, label, missing=missing).fit(kept).stages[-1]
        deviations = kept.agg(*[F.stddev_samp(c).alias(c) for c in features]).first()
    found = [
        (f, abs(float(c)) * float(deviations[f] or 0.0), "POS" if c >= 0 else "NEG")
        for f, c in zip(features, model.coefficients.toArray())
    ]
    table = train.sparkSession.createDataFrame(found, "feature string, magnitude double, sign string")
    return table.orderBy(F.desc("magnitude"), "feature")


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows without a missing value in ``columns``, which is what a regression table is fitted on."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]))


def _binomial(features: Sequence[str], label: str) -> Pipeline:
    glm = GeneralizedLinearRegression(featuresCol=FEATURES, labelCol=label, family="binomial", link="logit", maxIter=25)
    return Pipeline(stages=[assembler(features, "skip"), glm])


def logistic_table(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Estimate, standard error, z value and p value per coefficient, over the rows without missing values."""
    with held(train) as kept:
        model = _binomial(features, label).fit(kept).stages[-1]
        summary = model.summary
        estimates = [*model.coefficients.toArray(), model.intercept]
        columns = zip([*features, "(Intercept)"], estimates, summary.coefficientStandardErrors, summary.tValues, summary.pValues)
        rows = [(n, *[float(x) for x in values]) for n, *values in columns]
    return train.sparkSession.createDataFrame(
        rows, "term string, estimate double, std_error double, z_value double, p_value double"
    )


def stepwise_aic(
    train: DataFrame, features: Sequence[str], label: str, factors: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Backward elimination by AIC: one row per step with the term dropped and the AIC reached.

    A term is a feature, or all 0/1 columns of one of the ``factors`` (name -> columns). All fits use the rows without a
    missing value in any of the features, so that their AIC can be compared.
    """
    factors = dict(factors or {})
    in_factor = {c for columns in factors.values() for c in columns}
    terms = {**{f: [f] for f in features if f not in in_factor}, **{name: list(cols) for name, cols in factors.items()}}

    def aics(candidates: Sequence[Sequence[str]], kept: DataFrame) -> list[float]:
        return logistic_aic(kept, [[c for n in names for c in terms[n]] for names in candidates], label)

    left, steps = list(terms), []
    with held(complete_rows(train, features)) as kept:
        best = aics([left], kept)[0]
        steps.append((0, "", len(left), best, ",".join(left)))
        while len(left) > 1:
            aic, drop = min(zip(aics([[t for t in left if t != d] for d in left], kept), left))
            if aic >= best:
                break
            best = aic
            left.remove(drop)
            steps.append((len(steps), drop, len(left), aic, ",".join(left)))
    return train.sparkSession.createDataFrame(steps, "step int, dropped string, n_terms int, aic double, terms string")


def logistic_aic(rows: DataFrame, models: Sequence[Sequence[str]], label: str, rounds: int = 25, tolerance: float = 1e-7) -> list[float]:
    """The AIC of an unpenalised logistic model with an intercept for each list of features, over rows without missing values.

    All models are fitted together by iteratively reweighted least squares: a pass over the rows sums the weighted
    cross products of every model that still moves, and only those sums (features x features for each partition) reach
    the driver. The fit works on standardised features, which changes no likelihood.
    """
    columns = list(dict.fromkeys(c for names in models for c in names))
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    outcome = F.col(label).cast("double")
    bad = F.count_if(outcome.isNull() | ~outcome.between(0, 1))
    stats = rows.agg(bad, F.count(F.lit(1)), *[F.avg(x) for x in values], *[F.stddev_pop(x) for x in values]).first()
    if stats[0] or not stats[1]:
        raise ValueError(f"{label} must be between 0 and 1 in every row" if stats[0] else "no row without missing values")
    centre = np.array([0.0, *stats[2 : 2 + len(columns)]])
    scale = np.array([1.0, *[x or 1.0 for x in stats[2 + len(columns) :]]])
    places = [[0, *[1 + columns.index(c) for c in names]] for names in models]
    data = rows.select(outcome.alias("y"), *[x.alias(f"x{i}") for i, x in enumerate(values)])

    def sums(at: dict[int, np.ndarray | None]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
        """For each model its cross products, right-hand side and log likelihood at the given coefficients (None: the start)."""

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {i: np.zeros(len(places[i]) * (len(places[i]) + 1) + 1) for i in at}
            for batch in batches:
                y, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                every = (np.column_stack([np.ones(len(y)), *x]) - centre) / scale
                for i, beta in at.items():
                    own = every[:, places[i]]
                    if beta is None:
                        mean = (y + 0.5) / 2
                        line = np.log(mean / (1 - mean))
                    else:
                        line = own @ beta
                        mean = np.clip(1 / (1 + np.exp(-np.clip(line, -700, 700))), 1e-16, 1 - 1e-16)
                    weight = mean * (1 - mean)
                    weighted = own * weight[:, None]
                    fit = float(np.sum(y * np.log(mean) + (1 - y) * np.log1p(-mean)))
                    total[i] += np.concatenate([(weighted.T @ own).ravel(), weighted.T @ (line + (y - mean) / weight), [fit]])
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()])], names=["model", "sums"])

        found: dict[int, np.ndarray] = {}
        for row in data.mapInArrow(part, "model int, sums array<double>").collect():
            found[row.model] = found.get(row.model, 0.0) + np.array(row.sums)
        split = {}
        for i, v in found.items():
            n = len(places[i])
            split[i] = v[: n * n].reshape(n, n), v[n * n : n * n + n], float(v[-1])
        return split

    beta: dict[int, np.ndarray | None] = {i: None for i in range(len(models))}
    aic: dict[int, float] = {}
    for turn in range(rounds + 1):
        moving = {i: b for i, b in beta.items() if i not in aic}
        if not moving:
            break
        for i, (products, side, fit) in sums(moving).items():
            # Least squares of smallest length, as columns may depend on each other.
            new, old = np.linalg.lstsq(products, side, rcond=1e-12)[0], moving[i]
            if turn == rounds or (old is not None and np.max(np.abs(new - old)) < tolerance):
                aic[i] = -2 * fit + 2 * len(places[i])
            beta[i] = new
    return [aic[i] for i in range(len(models))]


def variance_inflation(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Diagonal of the inverse correlation matrix, over the rows without missing values.

    With a ``label`` the rows have the weights p(1-p) of the fitted logistic model, which makes it the table of that
    model. The matrix (features x features) is all that reaches the driver.
    """
    rows = complete_rows(df, features)
    weight = F.lit(1.0)
    if label is not None:
        rows = with_score(_binomial_scores(rows, features, label))
        weight = F.col(SCORE) * (1 - F.col(SCORE))
    values = [F.col(f).cast("double") for f in features]
    sums = rows.agg(
        F.sum(weight).alias("w"),
        *[F.sum(weight * x).alias(f"s{i}") for i, x in enumerate(values)],
        *[
            F.sum(weight * values[i] * values[j]).alias(f"q{i}_{j}")
            for i in range(len(values))
            for j in range(i, len(values))
        ],
    ).first()
    n = len(values)
    means = np.array([sums[f"s{i}"] / sums["w"] for i in range(n)])
    matrix = np.array([[sums[f"q{min(i, j)}_{max(i, j)}"] / sums["w"] for j in range(n)] for i in range(n)])
    covariance = matrix - np.outer(means, means)
    scale = np.sqrt(np.diag(covariance))
    found = np.diag(np.linalg.inv(covariance / np.outer(scale, scale)))
    rows_out = [(f, float(v)) for f, v in zip(features, found)]
    return df.sparkSession.createDataFrame(rows_out, "feature string, vif double")


def _binomial_scores(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``rows`` with the probability of an unpenalised logistic model fitted on them."""
    return logistic(features, label, reg=0.0, missing="skip").fit(rows).transform(rows)
