"""Mixing sources to target weights: raking to source, language and topic marginals, then calibrated sampling."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.base import lower_ascii, written

MISSING = "(none)"

#: Target share of a level without a given target: its share of tokens to this power, so that large ones shrink.
SMOOTHING = 0.9

#: The raking ends when no marginal is further from its target than this share, or after so many rounds.
TOLERANCE, MOST_ROUNDS = 1e-9, 200

#: Sources up to this number are broadcast to the documents; beyond it the join is left to Spark.
BROADCAST_SOURCES = 200_000

# Marks of the topics, the first that a text contains decides.
TOPIC_MARKS = {
    "legal": ("licen", "copyright", "all rights reserved"),
    "code": ("def ", "class ", "return ", "{", "=>"),
    "contact": ("@",),
    "table": (" | ",),
}


def topic_of(text: str | Column) -> Column:
    """A coarse topic by the marks that a text contains; ``prose`` without any."""
    low = lower_ascii(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    choice = None
    for topic, marks in TOPIC_MARKS.items():
        found = reduce(Column.__or__, [F.contains(low, F.lit(m)) for m in marks])
        choice = F.when(found, topic) if choice is None else choice.when(found, topic)
    return choice.otherwise("prose")


def rake(tokens: np.ndarray, targets: tuple[np.ndarray, np.ndarray], factors: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Factors of rows and columns that bring the sums of a table to the target shares of both."""
    rows, columns = (f.copy() for f in factors)
    total = tokens.sum()
    for _ in range(1000):
        sums = tokens @ columns
        rows = np.divide(targets[0] * total, sums, out=np.zeros_like(sums), where=sums > 0)
        sums = rows @ tokens
        columns = np.divide(targets[1] * total, sums, out=np.zeros_like(sums), where=sums > 0)
        if np.abs(rows * (tokens @ columns) / total - targets[0]).max() < 1e-14:
            break
    return rows, columns


@dataclass(frozen=True)
class Mix:
    """Calibrated weights: the weight of a cell is the product of the factors of its source, language and topic."""

    #: ``source``, ``factor``, ``target``, ``residual`` of every source, a written table.
    sources: DataFrame
    #: Level -> factor, target share, and how far the share that the weights reach is above it.
    langs: dict[str, tuple[float, float, float]]
    topics: dict[str, tuple[float, float, float]]
    #: The largest weight of a cell.
    most: float
    rounds: int
    #: The largest distance of any marginal to its target.
    error: float


_DIMENSIONS = ("source", "lang", "topic")


def _labelled(documents: DataFrame, text: str, source: str, lang: str, topic: str | None) -> dict[str, Column]:
    def own(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING)) if name in documents.columns else F.lit(MISSING)

    return {"source": own(source), "lang": own(lang), "topic": own(topic) if topic else topic_of(F.col(f"`{text}`"))}


def _goal(given: Mapping[str, float] | None, names: list[str], tokens: np.ndarray, dimension: str) -> np.ndarray:
    """Target shares of the levels of a small dimension."""
    if given is None:
        wanted = (tokens / tokens.sum()) ** SMOOTHING
    else:
        _check(given, set(names), dimension)
        wanted = np.array([float(given.get(n, 0.0)) for n in names])
    return wanted / wanted.sum()


def _check(given: Mapping[str, float], known: set[str], dimension: str) -> None:
    strange = sorted(n for n, share in given.items() if share > 0 and n not in known)
    if strange or not any(share > 0 for share in given.values()):
        raise ValueError(f"{dimension} levels with a target but without tokens: {strange}")


def fit_mix(labelled: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None) -> Mix | None:
    """Weights that bring the tokens of ``labelled`` (``source``, ``lang``, ``topic``, ``tokens``) to their targets; None without tokens.

    ``targets`` may give shares for the levels of a dimension (scaled to a sum of 1; a level that is not named gets
    none, a named one without tokens is an error); a dimension that is not named is smoothed.

    Sources can be many, so they stay in Spark: one row per source holds its tokens by language and topic. A
    round scales every source to its target, sums what that gives per language and topic in one job with map-side combine, and
    rakes that table, whose size is languages times topics, on the driver. Sources, languages and topics of any number
    and rarity have their own factor; none is pooled, and no weight is bounded.
    """
    given = targets or {}
    cells = written(labelled.groupBy(*_DIMENSIONS).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0"))
    small = {}
    for name in ("lang", "topic"):
        sums = sorted(tuple(r) for r in cells.groupBy(name).agg(F.sum("tokens")).collect())
        if not sums:
            return None
        small[name] = ([r[0] for r in sums], np.array([r[1] for r in sums]))
    (langs, of_lang), (topics, of_topic) = small["lang"], small["topic"]
    total = float(of_lang.sum())
    goals = _goal(given.get("lang"), langs, of_lang, "lang"), _goal(given.get("topic"), topics, of_topic, "topic")
    at = F.array_position(_known(langs, "array<string>"), F.col("lang")) - 1
    at = at * len(topics) + F.array_position(_known(topics, "array<string>"), F.col("topic")) - 1
    per_source = cells.select("source", at.alias("at"), "tokens").groupBy("source")
    per_source = per_source.agg(F.sum("tokens").alias("own"), F.array_sort(F.collect_list(F.struct("at", "tokens"))).alias("cells"))
    share = given.get("source")
    if share is None:
        per_source = per_source.withColumn("wanted", F.pow(F.col("own") / F.lit(total), F.lit(SMOOTHING)))
    else:
        named = [n for n, v in share.items() if v > 0]
        _check(share, {r.source for r in per_source.where(F.col("source").isin(named)).select("source").collect()}, "source")
        rows = labelled.sparkSession.createDataFrame([(n, float(share[n])) for n in named], "source string, wanted double")
        per_source = per_source.join(rows, "source", "left").withColumn("wanted", F.coalesce("wanted", F.lit(0.0)))
    per_source = written(per_source)
    every = float(per_source.agg(F.sum("wanted")).first()[0])
    target = F.col("wanted") / F.lit(every)

    def scaled(factors: tuple[np.ndarray, np.ndarray]) -> DataFrame:
        """The sources with the sum of their cells under the factors, and the factor that brings it to the target."""
        both = _known(np.outer(*factors).reshape(-1).tolist(), "array<double>")
        sums = F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["tokens"] * F.get(both, c["at"].cast("int")))
        return per_source.withColumn("sum", sums).withColumn("factor", F.when(F.col("sum") > 0, target * F.lit(total) / F.col("sum")).otherwise(0.0))

    def table(factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(langs) * len(topics))
        spread = scaled(factors).select("factor", F.explode("cells").alias("c"))
        for r in spread.groupBy("c.at").agg(F.sum(F.col("factor") * F.col("c.tokens")).alias("n")).collect():
            out[r[0]] = r[1]
        return out.reshape(len(langs), len(topics))

    factors = np.ones(len(langs)), np.ones(len(topics))
    rounds, before = 0, np.inf
    while True:
        rounds += 1
        tokens = table(factors)
        reached = factors[0][:, None] * tokens * factors[1]
        off = reached.sum(axis=1) / total - goals[0], reached.sum(axis=0) / total - goals[1]
        error = max(float(np.abs(x).max()) for x in off)
        # Targets that no weights meet: the distance stops shrinking.
        if error < TOLERANCE or rounds >= MOST_ROUNDS or (rounds > 20 and error > 0.999 * before):
            break
        before = error
        factors = rake(tokens, goals, factors)
    done = scaled(factors)
    best = _known(np.outer(*factors).reshape(-1).tolist(), "array<double>")
    highest = F.array_max(F.transform("cells", lambda c: F.get(best, c["at"].cast("int")))) * F.col("factor")
    gone = F.when(F.col("sum") > 0, F.lit(0.0)).otherwise(-target)
    sources = written(done.select("source", "factor", target.alias("target"), gone.alias("residual"), highest.alias("highest")))
    found = sources.agg(F.max("highest").alias("most"), F.max(F.abs("residual")).alias("gone")).first()

    def levels(names: list[str], factor: np.ndarray, goal: np.ndarray, off: np.ndarray) -> dict:
        return {n: (float(f), float(g), float(o)) for n, f, g, o in zip(names, factor, goal, off, strict=True)}

    return Mix(
        sources.drop("highest"),
        levels(langs, factors[0], goals[0], off[0]),
        levels(topics, factors[1], goals[1], off[1]),
        float(found.most),
        rounds,
        max(error, float(found.gone)),
    )


def _known(value: list, form: str) -> Column:
    """A list as one constant of the plan."""
    return F.from_json(F.lit(json.dumps(value)), form)


def _chosen(document: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the document and the seed only."""
    code = F.xxhash64(F.coalesce(document.cast("string"), F.lit("")), F.lit(seed))
    return F.shiftrightunsigned(code, 11).cast("double") / F.lit(float(1 << 53))


def mix_decisions(
    documents: DataFrame,
    document: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: str | None = None,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    seed: int = 7,
) -> DataFrame:
    """Every document with its cell, weight, sampling probability, the residuals of its levels, and whether it is sampled.

    Tokens are counted as runs without white space; ``topic`` names a column with the topic, without it
    :func:`topic_of` decides by marks in the text. Iterative proportional fitting scales the token sums of the cells
    (source, language, topic) until all three marginals meet their targets. The probability of a
    document is the weight of its cell over the largest weight, so the sample has the target shares (and is small where a rare level has a
    high target). A hash of its id decides, so that a rerun or a recomputed task draws the same documents; none is repeated.
    ``residual_source``, ``residual_lang`` and ``residual_topic`` tell how far the weighted share of the level is above its target: 0 up to
    rounding, unless no weights meet all targets.

    One pass over the texts writes their labels; everything else works on that small table. There is no shuffle of
    documents, so a hot source is no hot task.

    Defined cases: a null text has no tokens; a null or absent source, language or topic is the level ``(none)``; documents of a cell without
    tokens have the weight 1 and are sampled; repeated rows share their decision; an empty table gives an empty result; other columns are not read.
    """
    labels = _labelled(documents, text, source, lang, topic)
    labelled = written(documents.select(F.col(f"`{document}`").alias("doc_id"), *[c.alias(n) for n, c in labels.items()], _words(text).alias("tokens")))
    decided = _decided(labelled, fit_mix(labelled, targets), {n: F.col(n) for n in _DIMENSIONS}, F.col("doc_id"), seed)
    residuals = [f"residual_{n}" for n in _DIMENSIONS]
    return decided.select("doc_id", *_DIMENSIONS, "tokens", "weight", "probability", *residuals, "sampled")


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _decided(rows: DataFrame, mix: Mix | None, labels: Mapping[str, Column], document: Column, seed: int) -> DataFrame:
    """The rows with their labels, weight, probability, residuals and the decision."""
    if mix is None:
        numbers = {"weight": 1.0, "probability": 1.0, **{f"residual_{n}": 0.0 for n in _DIMENSIONS}}
        plain = rows.withColumns({n: F.lit(v) for n, v in numbers.items()})
        return plain.withColumn("sampled", F.lit(True))
    side = mix.sources.select(F.col("source").alias("__source"), F.col("factor").alias("__factor"), F.col("residual").alias("residual_source"))
    if mix.sources.count() <= BROADCAST_SOURCES:
        side = F.broadcast(side)
    # The labels as columns: the topic is asked for several times, and deciding it reads the text.
    own = rows.withColumns({f"__own_{n}": label for n, label in labels.items()})
    joined = own.join(side, F.col("__own_source") == F.col("__source"), "left")

    def number(levels: dict[str, tuple], label: Column, which: int) -> Column:
        return F.get(_known([v[which] for v in levels.values()], "array<double>"), (F.array_position(_known([*levels], "array<string>"), label) - 1).cast("int"))

    lang, topic = F.col("__own_lang"), F.col("__own_topic")
    weight = F.col("__factor") * number(mix.langs, lang, 0) * number(mix.topics, topic, 0)
    joined = joined.withColumns(
        {
            "weight": F.coalesce(weight, F.lit(1.0)),
            "probability": F.coalesce(weight / F.lit(mix.most), F.lit(1.0)),
            "residual_lang": number(mix.langs, lang, 2),
            "residual_topic": number(mix.topics, topic, 2),
        }
    ).drop("__factor", "__source", *[f"__own_{n}" for n in labels])
    return joined.withColumn("sampled", _chosen(document, seed) < F.col("probability"))


def mixed(
    documents: DataFrame,
    document: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: str | None = None,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    seed: int = 7,
) -> DataFrame:
    """The documents that :func:`mix_decisions` samples, with their columns."""
    columns = documents.columns
    own = documents.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(columns)])
    at = {c: f"in{i}" for i, c in enumerate(columns)}
    text_as, topic_as = at[text], at.get(topic, "-") if topic else None
    labels = _labelled(own, text_as, at.get(source, "-"), at.get(lang, "-"), topic_as)
    mix = fit_mix(own.select(*[c.alias(n) for n, c in labels.items()], _words(text_as).alias("tokens")), targets)
    decided = _decided(own, mix, labels, F.col(at[document]), seed)
    return decided.where("sampled").select(*[F.col(n).alias(c) for c, n in at.items()])
