"""Model jobs on a table with a planted signal."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import evaluate as ev
from eventloom.plans import models as m

FEATURES = ["x1", "x2", "noise"]


@pytest.fixture(scope="module")
def data(spark):
    """The label depends on x1 strongly, on x2 weakly, on noise not at all."""
    unit = lambda salt: F.pmod(F.xxhash64(F.concat_ws("-", "id", F.lit(salt))), F.lit(1000)) / 1000.0
    df = spark.range(1500).select("id", unit("a").alias("x1"), unit("b").alias("x2"), unit("c").alias("noise"), unit("d").alias("u"))
    chance = 1 / (1 + F.exp(-(6 * F.col("x1") + 2 * F.col("x2") - 4)))
    df = df.withColumn("y", (F.col("u") < chance).cast("int")).drop("u").cache()
    return df.filter("id < 1000"), df.filter("id >= 1000")


def check(scored, name=m.SCORE):
    low, high = scored.agg(F.min(name), F.max(name)).first()
    assert 0.0 <= low <= high <= 1.0
    assert ev.auc(scored, "y", name).first().auc > 0.7


@pytest.mark.parametrize(
    "build",
    [
        lambda: m.gbt(FEATURES, "y", rounds=5),
        lambda: m.random_forest(FEATURES, "y", trees=10),
        lambda: m.logistic(FEATURES, "y"),
        lambda: m.perceptron(FEATURES, "y", hidden=(5,), rounds=30),
    ],
    ids=["gbt", "forest", "logistic", "perceptron"],
)
def test_single_models(data, build):
    train, test = data
    scored = m.fit_score(build(), train, test)
    assert scored.count() == 500 and set(scored.columns) == {*test.columns, m.SCORE}
    check(scored)


def test_early_stopping_and_weights(data):
    train, test = data
    flagged = train.withColumn("valid", F.col("id") % 4 == 0).withColumn("w", F.lit(1.0))
    check(m.fit_score(m.gbt(FEATURES, "y", rounds=8, weight="w", validation="valid"), flagged, test))


def test_stacks(data):
    train, test = data
    bases = {"a": m.gbt(FEATURES, "y", rounds=3), "b": m.logistic(FEATURES, "y")}
    meta = lambda names: m.logistic(names, "y")
    check(m.stack_out_of_fold(bases, meta, train, test, ["id"]), "ensemble")
    check(m.stack_two_stage(bases, meta, train.filter("id < 600"), train.filter("id >= 600"), test), "ensemble")


def test_searches_are_ranked(data):
    train, _ = data
    values = {"maxDepth": [1, 2], "stepSize": [0.1, 0.2]}
    for table, n in (
        (m.grid_search(m.gbt(FEATURES, "y", rounds=2), values, train, "y", "id"), 4),
        (m.random_search(m.gbt(FEATURES, "y", rounds=2), values, train, "y", "id", models=2), 2),
    ):
        aucs = [r.auc for r in table.collect()]
        assert len(aucs) == n and aucs == sorted(aucs, reverse=True)


def test_selection_finds_the_signal(spark, data):
    train, test = data
    found = m.lasso_cv(train, FEATURES, "y", "id", [0.0001, 0.03])
    kept = {r.feature for r in found.coefficients.collect()}
    assert "x1" in kept and found.lambda_1se >= found.lambda_min
    steps = m.stepwise_aic(train, FEATURES, "y").orderBy("step").collect()
    assert "x1" in steps[-1].terms and [s.aic for s in steps] == sorted((s.aic for s in steps), reverse=True)
    assert m.coefficient_magnitudes(train, FEATURES, "y").first().feature == "x1"
    fitted = m.random_forest(FEATURES, "y", trees=10).fit(train)
    table = m.importance(spark, fitted, FEATURES).collect()
    assert table[0].feature == "x1" and sum(r.gain for r in table) == pytest.approx(100.0)
    forest = fitted.stages[-1]
    assert sum(r.splits for r in table) == (forest.totalNumNodes - 10) // 2
    both = m.importance_select(lambda names: m.gbt(names, "y", rounds=3), FEATURES, train, test, "y")
    check(m.with_score(both.model.transform(test)))
    both = both.table.collect()
    assert {r.fit for r in both} == {"all", "important"} and both[0].auc >= both[1].auc


def test_tables(data):
    train, test = data
    terms = {r.term: r for r in m.logistic_table(train, FEATURES, "y").collect()}
    assert set(terms) == {*FEATURES, "(Intercept)"} and terms["x1"].p_value < 0.001
    for r in m.variance_inflation(train, FEATURES).collect():
        assert 1.0 <= r.vif < 1.2
    row = m.cross_validate(m.logistic(FEATURES, "y"), train, "y", ["id"]).first()
    assert row.folds == 3 and row.auc_mean > 0.7
    board = m.leaderboard({"glm": m.logistic(FEATURES, "y"), "gbm": m.gbt(FEATURES, "y", rounds=3)}, train, test, "y")
    assert board.count() == 2


def test_save_and_balanced_fit(data, tmp_path):
    train, test = data
    model = m.balanced_fit(m.logistic(FEATURES, "y"), train, "id", "y")
    m.save(model, str(tmp_path / "model"))
    check(m.with_score(m.load(str(tmp_path / "model")).transform(test)))


def test_missing_values(spark, data):
    """One missing value: scoring models fill in the mean and score every row, tables leave the row out."""
    train, test = data
    gap = lambda df, i: df.withColumn("x2", F.when(F.col("id") != i, F.col("x2")))
    holed, holed_test = gap(train, 5), gap(test, 1000)
    for model in (m.logistic(FEATURES, "y"), m.perceptron(FEATURES, "y", hidden=(5,), rounds=10)):
        scored = m.fit_score(model, holed, holed_test)
        assert scored.count() == test.count() and scored.where(f"{m.SCORE} IS NULL").count() == 0
        assert set(scored.columns) == {*test.columns, m.SCORE}
    skipping = m.fit_score(m.logistic(FEATURES, "y", missing="skip"), holed, holed_test)
    assert skipping.count() == test.count() - 1
    whole = train.where("id <> 5")
    for fit in (m.logistic_table, m.coefficient_magnitudes, m.variance_inflation):
        given = fit(holed, FEATURES, "y") if fit is not m.variance_inflation else fit(holed, FEATURES)
        wanted = fit(whole, FEATURES, "y") if fit is not m.variance_inflation else fit(whole, FEATURES)
        for a, b in zip(given.collect(), wanted.collect(), strict=True):
            assert [x for x in a if isinstance(x, float)] == pytest.approx([x for x in b if isinstance(x, float)], rel=1e-4)
    assert m.stepwise_aic(holed, FEATURES, "y").first().aic == pytest.approx(m.stepwise_aic(whole, FEATURES, "y").first().aic)


def test_weighted_inflation(data):
    """The table of the logistic fit: rows have the weights p(1-p)."""
    import numpy as np

    train, _ = data
    p = m.with_score(m.logistic(FEATURES, "y", reg=0.0).fit(train).transform(train)).toPandas()
    w = (p[m.SCORE] * (1 - p[m.SCORE])).to_numpy()
    x = p[FEATURES].to_numpy()
    x = (x - np.average(x, axis=0, weights=w)) * np.sqrt(w)[:, None]
    wanted = np.diag(np.linalg.inv(x.T @ x)) * np.diag(x.T @ x)
    got = [r.vif for r in m.variance_inflation(train, FEATURES, "y").collect()]
    assert got == pytest.approx(list(wanted), rel=1e-4)


def test_categories_have_no_order(spark):
    """Levels 0..19 whose parity decides: one split on a category finds it, splits on the number do not."""
    df = spark.range(2000).select("id", (F.col("id") % 20).cast("int").alias("c"), F.pmod(F.xxhash64("id"), F.lit(10)).alias("r"))
    df = df.withColumn("y", ((F.col("c") % 2 == 0) == (F.col("r") < 9)).cast("int")).drop("r")
    levels = m.level_counts(df, ["c"])
    assert levels == {"c": 20}

    def auc(model):
        return ev.auc(m.fit_score(model, df, df), "y", m.SCORE).first().auc

    assert auc(m.random_forest(["c"], "y", 1, depth=1, categorical=levels, bootstrap=False)) > 0.85
    assert auc(m.random_forest(["c"], "y", 1, depth=1, bootstrap=False)) < 0.65
    assert auc(m.gbt(["c"], "y", rounds=1, depth=1, subsample=1.0, categorical=levels)) > 0.85
    assert auc(m.gbt(["c"], "y", rounds=3, depth=1, subsample=1.0, categorical={"c": 5000}, encode=["c"])) > 0.85
    with pytest.raises(ValueError):
        m.gbt(["c"], "y", categorical={"c": 5000})
    unseen = m.fit_score(m.gbt(["c"], "y", rounds=1, categorical=levels), df.where("c < 19"), df)
    assert unseen.where(f"{m.SCORE} IS NULL").count() == 0


def test_searches_do_not_depend_on_partitions(data):
    train, _ = data
    two, seven = train.repartition(2), train.repartition(7, "x1")
    model = lambda: m.gbt(FEATURES, "y", rounds=3)
    values = {"maxDepth": [1, 2]}
    tables = [[tuple(r) for r in m.grid_search(model(), values, d, "y", "id").collect()] for d in (two, seven)]
    assert tables[0] == tables[1]
    tables = [[tuple(r) for r in m.cross_validate(model(), d, "y", ["id"]).collect()] for d in (two, seven)]
    assert tables[0] == tables[1]


def test_lasso_errors_by_hand(data):
    """The rule of one standard error, from fold errors computed here."""
    import numpy as np

    from eventloom.operators.sampling import uniform

    train, _ = data
    regs = [0.2, 0.02, 0.002]
    found = m.lasso_cv(train, FEATURES, "y", "id", regs)
    fold = train.withColumn("f", F.floor(uniform("id", 1) * 3)).toPandas()
    wanted = []
    for reg in regs:
        errors = []
        for i in range(3):
            ids = fold.id[fold.f == i].tolist()
            model = m.logistic(FEATURES, "y", alpha=1.0, reg=reg).fit(train.where(~F.col("id").isin(ids)))
            p = m.with_score(model.transform(train.where(F.col("id").isin(ids)))).toPandas()
            errors.append(((p.y - p[m.SCORE]) ** 2).mean())
        wanted.append((reg, np.mean(errors), np.std(errors) / np.sqrt(2)))
    for a, b in zip(found.errors, wanted, strict=True):
        assert a == pytest.approx(b, rel=1e-4)
    best = min(wanted, key=lambda e: e[1])
    assert found.lambda_min == best[0]
    assert found.lambda_1se == max(e[0] for e in wanted if e[1] <= best[1] + best[2])
    path = m.lasso_path(train, FEATURES, "y", count=4)
    assert path == sorted(path, reverse=True) and path[-1] == pytest.approx(path[0] / 100)
    highest = m.logistic(FEATURES, "y", alpha=1.0, reg=path[0] * 1.01).fit(train).stages[-1]
    assert not highest.coefficients.toArray().any()


def test_scoring_history_falls(data):
    train, test = data
    losses = [r.loss for r in m.scoring_history(m.gbt(FEATURES, "y", rounds=5).fit(train), test).collect()]
    assert len(losses) == 5 and losses[-1] < losses[0]


def test_staged_margins_are_those_of_shorter_fits(data):
    """The first trees of a long fit score like a fit with as many rounds, and the chosen round has the best AUC."""
    train, test = data
    fits = {r: m.gbt(FEATURES, "y", rounds=r).fit(train) for r in (1, 3, 5)}
    staged = {r.round: r.auc for r in m.staged_auc(fits[5], test, "y").collect()}
    assert sorted(staged) == [1, 2, 3, 4, 5]
    for rounds, fitted in fits.items():
        want = {r.id: r[m.SCORE] for r in m.with_score(fitted.transform(test)).collect()}
        got = {r.id: r[m.SCORE] for r in m.score_at(fits[5], test, rounds).collect()}
        assert got == pytest.approx(want, abs=1e-12)
        assert staged[rounds] == pytest.approx(ev.auc(m.score_at(fits[5], test, rounds), "y", m.SCORE).first().auc)
    best = m.best_round(fits[5], test, "y")
    assert staged[best] == max(staged.values()) and all(staged[r] < staged[best] for r in staged if r < best)
    assert m.score_at(fits[5], test, best).columns == [*test.columns, m.SCORE]


def test_race_finds_the_winner_with_fewer_rows(data):
    train, test = data
    candidates = {
        "good": m.gbt(FEATURES, "y", rounds=5),
        "noise": m.gbt(["noise"], "y", rounds=2),
        "weak": m.gbt(["x2"], "y", rounds=2),
        "noise2": m.logistic(["noise"], "y"),
    }
    rows = m.race(candidates, train, test, "y", "id", start=0.25).collect()
    assert rows[0].model == "good" == m.leaderboard(candidates, train, test, "y").first().model
    assert rows[0].rows == train.count() and rows[0].rung == max(r.rung for r in rows)
    assert sum(r.rows for r in rows) < 0.8 * 4 * train.count()
    assert [len({r.model for r in rows if r.rung == g}) for g in (1, 2, 3)] == [4, 2, 1]
    # Within the tolerance nobody leaves before the whole table has been used.
    patient = m.race(candidates, train, test, "y", "id", start=0.5, tolerance=1.0).collect()
    assert [len([r for r in patient if r.rung == g]) for g in (1, 2)] == [4, 4]


def test_models_fitted_together_have_the_aic_of_single_fits(spark):
    """Also with a column that others determine, and in as many passes as the slowest model needs."""
    rows = spark.range(4000).select(
        (F.col("id") % 13).cast("double").alias("a"), (F.col("id") % 7 * 1000 + 5e6).alias("b"),
        (F.col("id") % 3 == 0).cast("double").alias("c"), ((F.col("id") * 37 % 100) < 30 + 3 * (F.col("id") % 13)).cast("int").alias("y"),
    )
    sets = [["a", "b", "c"], ["a"], ["b", "c"]]
    found = m.logistic_aic(rows, sets, "y")
    single = [m._binomial(names, "y").fit(rows).stages[-1].summary.aic for names in sets]
    assert found == pytest.approx(single, rel=1e-9)
    twice = rows.withColumn("d", F.col("a") * 2 - 1)
    assert m.logistic_aic(twice, [["a", "d"]], "y")[0] == pytest.approx(found[1] + 2, rel=1e-9)
    with pytest.raises(ValueError):
        m.logistic_aic(rows.withColumn("y", F.lit(None).cast("int")), [["a"]], "y")


def test_fixed_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(m, "TASK_ROWS", 100)
    assert m.fixed_rows(spark.range(3000), "id").rdd.getNumPartitions() == 30
    assert m.fixed_rows(spark.range(300), "id").rdd.getNumPartitions() == m.FIXED_PARTITIONS


def test_kept_frames_have_few_partitions(spark, monkeypatch):
    """Passes report to the driver by task, so a small table in many partitions is united, and a larger one less."""
    rows = spark.range(3000).repartition(200)
    with m.held(rows) as kept:
        assert kept.rdd.getNumPartitions() == m.FIT_PARTITIONS and kept.count() == 3000
    monkeypatch.setattr(m, "TASK_ROWS", 50)
    with m.held(rows, rows.limit(0)) as (kept, none):
        assert kept.rdd.getNumPartitions() == 60 and none.count() == 0


def test_thirty_two_partitions_are_united_too(spark):
    """A small table that is kept in as many partitions as a mid-sized shuffle has."""
    with m.held(spark.range(3000).repartition(32)) as kept:
        assert kept.rdd.getNumPartitions() == 16 and kept.count() == 3000
