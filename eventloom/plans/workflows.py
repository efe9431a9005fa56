"""The two complete jobs: from raw tables to a submission."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from eventloom.functions import text
from eventloom.operators.evaluate import arithmetic_mean
from eventloom.operators.relational import align_mean, append_by_name, split_back, tail_flag
from eventloom.operators.sampling import class_weight
from eventloom.operators.stats import z_scores
from eventloom.plans import models as m
from eventloom.plans.pipelines import APPENDED_ORDER, features_lgb
from eventloom.sources.files import cached_parquet, scratch_folder
from eventloom.views import CLICK_ORDER

#: Columns whose values have no order.
LEVELS = ("app", "device", "os", "channel", "hour")
SIX_KEYS = ("ip", "app", "device", "os", "channel", "click_time")
RAW = ("click_id", "ip", "click_time", "day", "is_attributed", "src_rank", "is_valid", "weight")


def attribution_submission(
    train: DataFrame, supplement: DataFrame, test: DataFrame, valid_rows: int, rounds: int = 20, positive: float = 200
) -> DataFrame:
    """(click_id, is_attributed) for every test click.

    Features over train and supplement together, the last ``valid_rows`` training rows held out for
    early stopping, boosted trees with declared categorical columns, and the mean prediction per click key aligned with the test set.
    """
    # The hold-out is marked on the raw rows, and the features of both tables are computed and written once.
    marked = tail_flag(train, CLICK_ORDER, valid_rows)
    featured = features_lgb(append_by_name([marked, supplement]), APPENDED_ORDER)
    stored = cached_parquet(featured, f"{scratch_folder(train.sparkSession)}/features")
    fit_on, score_on = split_back(stored, 0), split_back(stored, 1)
    fit_on = fit_on.withColumn("weight", class_weight("is_attributed", positive))
    features = [c for c in fit_on.columns if c not in RAW]
    levels = m.level_counts(fit_on, [c for c in LEVELS if c in features])
    many = [c for c, n in levels.items() if n > m.TREE_LEVELS]
    model = m.gbt(
        features, "is_attributed", rounds=rounds, weight="weight", validation="is_valid", categorical=levels, encode=many
    )
    # missing gaps (no neighbour) are missing feature values; trees of this library need a number
    fit_on, score_on = fit_on.fillna(-1, features), score_on.fillna(-1, features)
    scored = m.fit_score(model, fit_on, score_on.drop("is_attributed"), "is_attributed")
    return align_mean(test, scored, SIX_KEYS, "is_attributed").select("click_id", "is_attributed")


def clean_members(df: DataFrame) -> DataFrame:
    """Dates as numbers, gender as 0/1 by one rule for all tables, nothing missing."""
    dates = [c for c in df.columns if c.endswith("_date")]
    recoded = {**{c: text.strip_all(c) for c in dates}, "gender": text.recode_gender("gender")}
    return df.withColumns(recoded).fillna(0)


def churn_submission(
    train: DataFrame, test: DataFrame, builds: dict[str, Callable[[Sequence[str], str], Estimator]], key: str = "msno", label: str = "is_churn"
) -> DataFrame:
    """(key, label) with the mean score of several models for every test member.

    Scaling is fitted on the training members and applied to both tables.
    """
    train, test = clean_members(train), clean_members(test)
    features = [c for c in train.columns if c not in (key, label)]
    scaled_train = z_scores(train, features)
    scored = z_scores(test.drop(label), features, fit_on=train)
    with m.held(scaled_train) as kept:
        for name, build in builds.items():
            estimator = build(features, label)
            scored = m.with_score(estimator.fit(kept).transform(scored), f"p_{name}")
    return scored.select(key, arithmetic_mean([f"p_{n}" for n in builds]).alias(label))


def default_builds(rounds: int = 200, passes: int = 50) -> dict[str, Callable[[Sequence[str], str], Estimator]]:
    """The model kinds that are averaged: boosted trees, forest, logistic regression, network.

    ``rounds`` are the trees of the boosting and of the forest, ``passes`` those of the network over the members. The defaults are
    the whole job: 200 trees each, and as many passes as :func:`~eventloom.plans.models.perceptron` makes by itself.
    """

    def network(features: Sequence[str], label: str) -> Estimator:
        return m.perceptron(features, label, rounds=passes)

    return {
        "gbm": lambda x, y: m.gbt(x, y, rounds=rounds),
        "rf": lambda x, y: m.random_forest(x, y, trees=rounds),
        "glm": lambda x, y: m.logistic(x, y),
        "dl": network,
    }
