"""Predictors left out one by one because the others explain them, from one correlation matrix."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.stats import correlation
from eventloom.plans.models import complete_rows

#: From this variance inflation on a predictor goes; a pivot below the tolerance means that others determine it.
LIMIT, TOLERANCE = 10.0, 1e-10


def sweep(matrix: np.ndarray, k: int) -> np.ndarray:
    """The matrix swept on its ``k``-th pivot; sweeping twice gives the matrix back.

    Swept on every pivot a correlation matrix becomes its inverse, whose diagonal holds the variance inflations. Swept
    on a pivot once more, it holds those of the predictors without that one.
    """
    pivot = matrix[k, k]
    out = matrix - np.outer(matrix[:, k], matrix[k]) / pivot
    out[k] = matrix[k] / pivot
    out[:, k] = -matrix[:, k] / pivot
    out[k, k] = 1 / pivot
    return out


def removals(matrix: np.ndarray, limit: float = LIMIT) -> tuple[list[tuple[int, float]], dict[int, float]]:
    """Which predictors go, in order with their inflation at that time, and the inflations of those that stay.

    First those that do not vary (nan) or that the predictors before them determine (infinite), then always the one with the largest
    inflation (of equal ones the last) until none exceeds the limit.
    """
    gone: list[tuple[int, float]] = []
    now = np.where(np.isnan(matrix), 0.0, matrix)
    inside = []
    for k in range(len(matrix)):
        if np.isnan(matrix[k, k]):
            gone.append((k, float("nan")))
        elif now[k, k] < TOLERANCE:
            gone.append((k, float("inf")))
        else:
            now = sweep(now, k)
            inside.append(k)
    while inside:
        worst = max(inside, key=lambda k: (now[k, k], k))
        if now[worst, worst] <= limit:
            break
        gone.append((worst, float(now[worst, worst])))
        now = sweep(now, worst)
        inside.remove(worst)
    return gone, {k: float(now[k, k]) for k in inside}


def screen_predictors(df: DataFrame, features: Sequence[str], limit: float = LIMIT) -> DataFrame:
    """``feature``, ``removed`` (1, 2 ... in order, null if it stays) and ``vif`` (when it went, or at the end), a row per feature.

    The rows without a missing value are read once, whatever the number of removals: the correlations of all pairs come from
    one aggregation with map-side combine, and only that matrix (features x features) reaches the driver. There the sweep
    operator takes predictors out of it, where fitting again would take a pass over the rows for each.
    ``vif`` is infinite for a feature that those before it determine, and missing for one that does not vary.
    """
    features = list(features)
    rows = complete_rows(df, features).select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    pairs = list(combinations(range(len(features)), 2))
    spread = [F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(len(features))]
    found = rows.agg(*spread, *[correlation(F.col(f"x{i}"), F.col(f"x{j}")).alias(f"r{i}_{j}") for i, j in pairs]).first()
    matrix = np.eye(len(features))
    for i in range(len(features)):
        if not found[f"s{i}"]:
            matrix[i, i] = np.nan
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = np.nan if found[f"r{i}_{j}"] is None else found[f"r{i}_{j}"]
    gone, stay = removals(matrix, limit)
    out = [(features[k], n, None if np.isnan(v) else v) for n, (k, v) in enumerate(gone, 1)]
    out += [(features[k], None, v) for k, v in stay.items()]
    return df.sparkSession.createDataFrame(out, "feature string, removed int, vif double")
