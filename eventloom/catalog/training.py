"""Queries that fit models.

The full-feature fits are seeded and checked by properties. Beside each kind of model stands a fit on factors, whose result
has a closed form that SQL states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import views
from eventloom.catalog.base import query, rounded
from eventloom.functions import text, timeparts
from eventloom.operators.evaluate import auc_of
from eventloom.operators.features import add_features, distinct_count, group_size, running_count
from eventloom.operators.relational import tail_flag
from eventloom.operators.sampling import class_weight, split_bands, split_exact
from eventloom.plans import models as m
from eventloom.plans import screening, workflows

CLICK_FEATURES = ["app", "device", "os", "channel", "hour", "ipcount", "ip_appcount", "ip_by_channel_countuniq", "ip_by_os_cumcount"]
CLICK_LEVELS = ("app", "device", "os", "channel", "hour")
RACE_NUMBERS = ["chulNo", "hrWeight", "rcDist", "trRcCnt"]
RACE_FACTORS = ["weather", "track", "hrSex"]
MEMBER_FEATURES = ["female", "n_trans", "max_paid", "fst", "lst", "balance"]


def click_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Training clicks with features, the last fifth marked as hold-out, and a class weight."""
    train = views.click_train(spark, folder)
    df = train.withColumn("hour", timeparts.hour_of("click_time"))
    df = add_features(
        df,
        [group_size(["ip"]), group_size(["ip", "app"]), distinct_count(["ip"], "channel"), running_count(["ip"], "os")],
    )
    df = tail_flag(df, views.CLICK_ORDER, train.count() // 5)
    return df.withColumn("weight", class_weight("is_attributed", 20))


def race_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Races with numbers as numbers, factors as text, and the outcome as 0/1."""
    df = views.races(spark, folder)
    count = text.strip_first_comma("trRcCntT").cast("double")
    return df.select(
        "race_id", *[F.col(c).cast("double").alias(c) for c in RACE_NUMBERS[:3]], count.alias("trRcCnt"), *RACE_FACTORS,
        text.recode_label("rcResult").alias("rcResult"),
    )


def race_frame(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Races with a 0/1 column for each level of a factor but the first, and the names of all predictors."""
    coded, names = m.dummies(race_rows(spark, folder), RACE_FACTORS)
    return coded, [*RACE_NUMBERS, *names]


def member_frame(spark: SparkSession, folder: str) -> DataFrame:
    return views.members(spark, folder).select(
        "msno", F.coalesce(text.recode_gender("gender"), F.lit(0)).alias("female"), "n_trans",
        F.coalesce("max_paid", F.lit(0.0)).alias("max_paid"),
        F.coalesce(text.strip_all("fst_exp_date"), F.lit(0.0)).alias("fst"),
        F.coalesce(text.strip_all("lst_exp_date"), F.lit(0.0)).alias("lst"),
        "balance", "is_churn",
    )


def parts(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    flagged = split_exact(df, key, 0.7)
    return flagged.filter("is_train").drop("is_train"), flagged.filter("NOT is_train").drop("is_train")


@query("model_gbt")
def _(spark, folder):
    df = click_frame(spark, folder)
    levels = m.level_counts(df, CLICK_LEVELS)
    many = [c for c, n in levels.items() if n > m.TREE_LEVELS]
    model = m.gbt(
        CLICK_FEATURES, "is_attributed", rounds=10, weight="weight", validation="is_valid", categorical=levels, encode=many
    )
    return m.fit_score(model, df, df.filter("is_valid")).select("click_id", "is_attributed", m.SCORE)


@query("model_rf")
def _(spark, folder):
    train, test = parts(member_frame(spark, folder), "msno")
    return m.fit_score(m.random_forest(MEMBER_FEATURES, "is_churn", trees=20), train, test).select("msno", "is_churn", m.SCORE)


@query("model_glm")
def _(spark, folder):
    train, test = parts(member_frame(spark, folder), "msno")
    return m.fit_score(m.logistic(MEMBER_FEATURES, "is_churn"), train, test).select("msno", "is_churn", m.SCORE)


@query("model_lasso")
def _(spark, folder):
    df, names = race_frame(spark, folder)
    found = m.lasso_cv(df, names, "rcResult", "race_id", m.lasso_path(df, names, "rcResult", count=5))
    return found.coefficients.withColumns(
        {"lambda_min": F.lit(found.lambda_min), "lambda_1se": F.lit(found.lambda_1se)}
    )


@query("model_mlp")
def _(spark, folder):
    train, test = parts(member_frame(spark, folder), "msno")
    model = m.perceptron(MEMBER_FEATURES, "is_churn", rounds=10)
    return m.fit_score(model, train, test).select("msno", "is_churn", m.SCORE)


@query("cv_metrics")
def _(spark, folder):
    df, names = race_frame(spark, folder)
    return m.cross_validate(m.logistic(names, "rcResult", rounds=10), df, "rcResult", ["race_id"], folds=3)


def bases(features, label):
    return {
        "gbm": m.gbt(features, label, rounds=5),
        "rf": m.random_forest(features, label, trees=10),
    }


@query("stack_oof")
def _(spark, folder):
    train, test = parts(member_frame(spark, folder), "msno")
    meta = lambda names: m.logistic(names, "is_churn", rounds=10)
    done = m.stack_out_of_fold(bases(MEMBER_FEATURES, "is_churn"), meta, train, test, ["msno"])
    return done.select("msno", "is_churn", "gbm", "rf", "ensemble")


@query("stack_two_stage")
def _(spark, folder):
    df = split_bands(member_frame(spark, folder), "msno", (0.5, 0.25))
    first, second, test = (df.filter(F.col("part") == i).drop("part") for i in range(3))
    meta = lambda names: m.logistic(names, "is_churn", rounds=10)
    done = m.stack_two_stage(bases(MEMBER_FEATURES, "is_churn"), meta, first, second, test)
    return done.select("msno", "is_churn", "gbm", "rf", "ensemble")


@query("grid_search")
def _(spark, folder):
    values = {"maxDepth": [2, 3], "subsamplingRate": [0.7, 0.9]}
    df, names = race_frame(spark, folder)
    return m.grid_search(m.gbt(names, "rcResult", rounds=5), values, df, "rcResult", "race_id")


@query("random_search")
def _(spark, folder):
    values = {"maxDepth": [2, 3, 4], "stepSize": [0.01, 0.03, 0.1], "subsamplingRate": [0.7, 0.8, 0.9, 1.0]}
    df, names = race_frame(spark, folder)
    return m.random_search(m.gbt(names, "rcResult", rounds=5), values, df, "rcResult", "race_id", models=3)


@query("leaderboard")
def _(spark, folder):
    train, test = parts(member_frame(spark, folder), "msno")
    candidates = {**bases(MEMBER_FEATURES, "is_churn"), "glm": m.logistic(MEMBER_FEATURES, "is_churn", rounds=10)}
    return m.leaderboard(candidates, train, test, "is_churn")


@query("race_equals_leaderboard", "SELECT true AS same_winner, true AS fewer_than_half")
def _(spark, folder):
    """Four sets of predictors: halving finds the winner of the whole leaderboard with under half of its rows."""
    races, names = race_frame(spark, folder)
    train, test = parts(races, "race_id")
    sets = {"all": names, "numbers": RACE_NUMBERS, "place": ["chulNo"], "weight": ["hrWeight"]}
    candidates = {n: m.logistic(x, "rcResult", rounds=10) for n, x in sets.items()}
    board = m.leaderboard(candidates, train, test, "rcResult").first()
    raced = m.race(candidates, train, test, "rcResult", "race_id").collect()
    fewer = sum(r.rows for r in raced) < 0.5 * len(candidates) * train.count()
    return spark.createDataFrame([(raced[0].model == board.model, fewer)], "same_winner boolean, fewer_than_half boolean")


@query("stepwise_aic")
def _(spark, folder):
    df, names = race_frame(spark, folder)
    factors = {f: [n for n in names if n.startswith(f"{f}_")] for f in RACE_FACTORS}
    return m.stepwise_aic(df, names, "rcResult", factors)


@query("importance")
def _(spark, folder):
    df = member_frame(spark, folder)
    fitted = m.random_forest(MEMBER_FEATURES, "is_churn", trees=10).fit(df)
    return m.importance(spark, fitted, MEMBER_FEATURES)


@query("importance_select")
def _(spark, folder):
    train, valid = parts(member_frame(spark, folder), "msno")
    build = lambda names: m.gbt(names, "is_churn", rounds=5)
    return m.importance_select(build, MEMBER_FEATURES, train, valid, "is_churn").table


@query("scoring_history_fit")
def _(spark, folder):
    train, valid = parts(member_frame(spark, folder), "msno")
    with m.held(train) as kept:
        fitted = m.gbt(MEMBER_FEATURES, "is_churn", rounds=5).fit(kept)
    return m.scoring_history(fitted, valid)


@query("staged_auc_equals_refits", "SELECT CAST(r AS INTEGER) AS round, true AS same FROM range(1, 5) AS t(r)")
def _(spark, folder):
    """The AUC after each round of one fit, against models fitted with as many rounds."""
    train, valid = parts(member_frame(spark, folder), "msno")
    with m.held(train) as kept:
        fits = [m.gbt(MEMBER_FEATURES, "is_churn", rounds=r).fit(kept) for r in range(1, 5)]
    staged = m.staged_auc(fits[-1], valid, "is_churn")
    scored = valid
    for r, fitted in enumerate(fits, 1):
        scored = m.with_score(fitted.transform(scored), f"s{r}")
    refits = auc_of(scored, "is_churn", [f"s{r}" for r in range(1, 5)])
    both = staged.join(refits.select(F.substring("model", 2, 10).cast("int").alias("round"), F.col("auc").alias("refit")), "round")
    return both.select("round", (F.abs(F.col("auc") - F.col("refit")) < 1e-9).alias("same"))


@query("score_at_best_round")
def _(spark, folder):
    """Scores of the held-out rows by the trees up to the round with the best AUC on other held-out rows."""
    train, valid = parts(member_frame(spark, folder), "msno")
    with m.held(train) as kept:
        fitted = m.gbt(MEMBER_FEATURES, "is_churn", rounds=6).fit(kept)
    chosen = valid.where(F.crc32(F.col("msno").cast("string")) % 2 == 0)
    return m.score_at(fitted, valid, m.best_round(fitted, chosen, "is_churn")).select("msno", m.SCORE)


@query("coef_magnitude")
def _(spark, folder):
    df, names = race_frame(spark, folder)
    return m.coefficient_magnitudes(df, names, "rcResult")


@query("glm_summary")
def _(spark, folder):
    df, names = race_frame(spark, folder)
    return m.logistic_table(df, names, "rcResult")


@query("attribution_submission")
def _(spark, folder):
    train = views.click_train(spark, folder)
    supplement, test = views.test_supplement(spark, folder), views.click_test(spark, folder)
    return workflows.attribution_submission(train, supplement, test, valid_rows=train.count() // 10, rounds=5, positive=20)


@query("churn_submission")
def _(spark, folder):
    train, test = parts(views.members(spark, folder), "msno")
    return workflows.churn_submission(train, test, workflows.default_builds(5, passes=5))


# --- fits with a closed form -----------------------------------------------------------------------
# A model whose only predictor is one factor can do no better, and no worse, than the share of each level.

_PASS = "CASE WHEN rcResult = 'pass' THEN 1.0 ELSE 0.0 END"
_SHARES = f"(SELECT track, avg({_PASS}) AS share, count(*) AS n FROM races GROUP BY track)"


def by_level(scored: DataFrame, factor: str = "track") -> DataFrame:
    """The scores of each level: all rows of one have the same."""
    found = scored.groupBy(factor).agg(F.min(m.SCORE).alias("low"), F.max(m.SCORE).alias("high"), F.count(F.lit(1)).alias("n"))
    return rounded(found, "low", "high", digits=4)


def _by_track_sql(value: str) -> str:
    return f"SELECT track, round({value}, 4) AS low, round({value}, 4) AS high, n FROM {_SHARES}"


@query("factor_glm", _by_track_sql("share"))
def _(spark, folder):
    df, names = m.dummies(race_rows(spark, folder), ["track"])
    return by_level(m.fit_score(m.logistic(names, "rcResult", alpha=0.0, reg=0.0, rounds=100), df, df))


@query(
    "factor_forest",
    f"""SELECT CAST(track = 'BUILDING' AS INT) AS building, round(avg({_PASS}), 4) AS low, round(avg({_PASS}), 4) AS high,
        count(*) AS n FROM races GROUP BY 1""",
)
def _(spark, folder):
    # Leaves that predict the same class are merged, so the factor here parts the classes.
    df = race_rows(spark, folder).withColumn("building", (F.col("track") == "BUILDING").cast("int"))
    model = m.random_forest(["building"], "rcResult", 1, categorical={"building": 2}, bootstrap=False)
    return by_level(m.fit_score(model, df, df), "building")


@query("factor_boosted_once", _by_track_sql("1 / (1 + exp(-2 * (2 * share - 1)))"))
def _(spark, folder):
    df = race_rows(spark, folder)
    levels = m.level_counts(df, ["track"])
    model = m.gbt(["track"], "rcResult", rounds=1, depth=5, step=1.0, subsample=1.0, categorical=levels)
    return by_level(m.fit_score(model, df, df))


@query(
    "factor_glm_table",
    f"""WITH c AS (SELECT track, sum({_PASS}) AS a, count(*) - sum({_PASS}) AS b FROM races GROUP BY track),
        f AS (SELECT * FROM c ORDER BY track LIMIT 1)
        SELECT 'track_' || c.track AS term, round(ln(c.a / c.b) - ln(f.a / f.b), 4) AS estimate,
          round(sqrt(1 / c.a + 1 / c.b + 1 / f.a + 1 / f.b), 4) AS std_error FROM c, f WHERE c.track <> f.track
        UNION ALL SELECT '(Intercept)', round(ln(a / b), 4), round(sqrt(1 / a + 1 / b), 4) FROM f""",
)
def _(spark, folder):
    df, names = m.dummies(race_rows(spark, folder), ["track"])
    found = m.logistic_table(df, names, "rcResult").select("term", "estimate", "std_error")
    return rounded(found, "estimate", "std_error", digits=4)


@query(
    "factor_aic",
    f"""SELECT CAST(0 AS INT) AS step, round(-2 * sum(n * (share * ln(share) + (1 - share) * ln(1 - share))) + 2 * count(*), 2) AS aic
        FROM {_SHARES}""",
)
def _(spark, folder):
    df, names = m.dummies(race_rows(spark, folder), ["track"])
    steps = m.stepwise_aic(df, names, "rcResult", {"track": names})
    return rounded(steps.where("step = 0").select("step", "aic"), "aic", digits=2)


@query(
    "churn_submission_rows",
    """WITH t AS (SELECT msno FROM members)
       SELECT CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS outside,
         count(*) - CAST(floor(count(*) * 0.7) AS BIGINT) AS n FROM t""",
)
def _(spark, folder):
    train, test = parts(views.members(spark, folder), "msno")
    done = workflows.churn_submission(train, test, workflows.default_builds())
    ids = test.select("msno").withColumn("known", F.lit(True))
    return done.join(ids, "msno", "left").agg(
        F.count_if(F.col("known").isNull()).alias("strangers"),
        (F.count("msno") - F.count_distinct("msno")).alias("repeated"),
        F.count_if(~F.col("is_churn").between(0, 1)).alias("outside"),
        F.count(F.lit(1)).alias("n"),
    )


_SCREENED = ["hrWeight", "rcDist", "chulNo", "mixed"]


@query(
    "screen_predictors",
    """WITH x AS (SELECT "hrWeight" AS a, "rcDist" AS b, "chulNo" AS c, "hrWeight" + "rcDist" / 30 + "chulNo" AS d FROM races),
        r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(a, d) AS ad, corr(b, c) AS bc, corr(b, d) AS bd, corr(c, d) AS cd FROM x),
        s AS (SELECT 1 + 2 * ab * ac * bc - ab ** 2 - ac ** 2 - bc ** 2 AS det FROM r)
        SELECT 'mixed' AS feature, 1 AS removed, CAST(NULL AS DOUBLE) AS vif
        UNION ALL SELECT 'hrWeight', NULL, round((1 - bc ** 2) / det, 6) FROM r, s
        UNION ALL SELECT 'rcDist', NULL, round((1 - ac ** 2) / det, 6) FROM r, s
        UNION ALL SELECT 'chulNo', NULL, round((1 - ab ** 2) / det, 6) FROM r, s""",
)
def _(spark, folder):
    """A predictor that others determine goes; the inflations of the rest are those of a matrix without it."""
    races = views.races(spark, folder).withColumn("mixed", F.expr("hrWeight + rcDist / 30 + chulNo"))
    found = screening.screen_predictors(races, _SCREENED)
    # What goes first has an infinite inflation, which prints differently elsewhere.
    return rounded(found.withColumn("vif", F.when(F.col("removed").isNull(), F.col("vif"))), "vif")


@query(
    "screen_predictors_twice",
    """WITH x AS (SELECT "rcDist" AS a, "rcDist" + 2 * "hrWeight" AS b, "hrWeight" AS c FROM races WHERE "chulNo" < 9
            UNION ALL SELECT "rcDist", "rcDist" - "hrWeight", "hrWeight" FROM races WHERE "chulNo" >= 9),
        r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc FROM x),
        v AS (SELECT *, 1 + 2 * ab * ac * bc - ab ** 2 - ac ** 2 - bc ** 2 AS det FROM r),
        f AS (SELECT 'a' AS feature, (1 - bc ** 2) / det AS vif FROM v UNION ALL SELECT 'b', (1 - ac ** 2) / det FROM v
            UNION ALL SELECT 'c', (1 - ab ** 2) / det FROM v),
        w AS (SELECT feature, vif FROM f ORDER BY vif DESC, feature DESC LIMIT 1),
        p AS (SELECT CASE w.feature WHEN 'a' THEN bc WHEN 'b' THEN ac ELSE ab END AS rest FROM v, w)
        SELECT w.feature, 1 AS removed, round(w.vif, 6) AS vif FROM w
        UNION ALL SELECT f.feature, NULL, round(1 / (1 - rest ** 2), 6) FROM f, w, p WHERE f.feature <> w.feature""",
)
def _(spark, folder):
    """Two predictors and their sum or difference by rows: the one with the largest inflation above 1.2 goes."""
    races = views.races(spark, folder)
    mixed = F.when(F.col("chulNo") < 9, F.expr("rcDist + 2 * hrWeight")).otherwise(F.expr("rcDist - hrWeight"))
    rows = races.select(F.col("rcDist").alias("a"), mixed.alias("b"), F.col("hrWeight").alias("c"))
    return rounded(screening.screen_predictors(rows, ["a", "b", "c"], limit=1.2), "vif")
