"""Distribution functions, tests of many columns and densities, against closed forms and plain sums."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from eventloom.functions import distributions as d
from eventloom.operators import stats as st


def test_log_gamma(spark):
    z = [0.05, 0.5, 1.0, 2.0, 3.7, 25.0, 1000.5, 1e7]
    rows = spark.createDataFrame([(x,) for x in z], "z double").select("z", d.log_gamma(F.col("z")).alias("g")).collect()
    for r in rows:
        assert r.g == pytest.approx(math.lgamma(r.z), rel=1e-12, abs=1e-12)


def binomial_tail(x, a, n):
    """I_x(a, n - a + 1) for whole a: the chance of a or more hits in n trials."""
    return sum(math.comb(n, k) * x**k * (1 - x) ** (n - k) for k in range(a, n + 1))


def test_incomplete_beta_of_whole_numbers(spark):
    draw = random.Random(1)
    cases = [(draw.random(), a, n) for n in (1, 2, 7, 30, 200) for a in {1, (n + 1) // 2, n}] + [(0.0, 2, 5), (1.0, 2, 5)]
    rows = spark.createDataFrame([(x, float(a), float(n - a + 1), a, n) for x, a, n in cases], "x double, a double, b double, k int, n int")
    for r in rows.select("*", d.incomplete_beta(F.col("x"), F.col("a"), F.col("b")).alias("got")).collect():
        assert r.got == pytest.approx(binomial_tail(r.x, r.k, r.n), abs=1e-12)


CLOSED = {
    1.0: lambda t: 1 - 2 / math.pi * math.atan(t),
    2.0: lambda t: 1 - t / math.sqrt(2 + t * t),
    4.0: lambda t: 1 - t / math.sqrt(4 + t * t) * (1.5 - 0.5 * t * t / (4 + t * t)),
}


def test_students_t(spark):
    rows = [(t, f) for f in CLOSED for t in (0.0, 0.3, 1.0, 4.0, 60.0)]
    frame = spark.createDataFrame(rows, "t double, f double")
    for r in frame.select("*", d.t_two_sided(F.col("t"), F.col("f")).alias("p"), d.t_two_sided(-F.col("t"), F.col("f")).alias("q")).collect():
        assert r.p == r.q == pytest.approx(CLOSED[r.f](r.t), abs=1e-12)
    # The 97.5 % points of Student's t in printed tables.
    table = {1.0: 12.7062047362, 2.0: 4.3026527297, 5.0: 2.5705818356, 30.0: 2.0422724563, 1000.0: 1.9623390808}
    found = spark.createDataFrame([(f,) for f in table], "f double").select("f", d.t_quantile(0.05, F.col("f")).alias("q")).collect()
    for r in found:
        assert r.q == pytest.approx(table[r.f], abs=1e-9)
    # With very many degrees of freedom it is the normal distribution.
    points = [(t, f) for t in (0.01, 0.5, 1.959963984540054, 3.0, 3.9, 4.1, 5.0, 7.6, 9.0, 20.0, 80.0) for f in (1e10,)]
    large = spark.createDataFrame(points, "t double, f double").select("*", d.t_two_sided(F.col("t"), F.col("f")).alias("p")).collect()
    for r in large:
        assert r.p == pytest.approx(math.erfc(r.t / math.sqrt(2)), abs=1e-10)


def test_tests_of_many_columns(spark):
    draw = random.Random(2)
    rows = []
    for i in range(200):
        a = draw.gauss(0, 1)
        rows.append((a, None if i % 9 == 0 else a + draw.gauss(0, 2), 5.0, draw.gauss(3, 2) + i % 2, i % 2))
    frame = spark.createDataFrame(rows, "a double, b double, c double, v double, g int")
    got = {(r.var1, r.var2): r for r in st.correlation_tests(frame, ["a", "b", "c"]).collect()}
    both = [(r[0], r[1]) for r in rows if r[1] is not None]
    r = statistics.correlation(*map(list, zip(*both, strict=True)))
    own = got["a", "b"]
    assert own.n == len(both) and own.df == own.n - 2 and own.r == pytest.approx(r)
    assert own.t == pytest.approx(r * math.sqrt(own.df / (1 - r * r)))
    half = 1.959963984540054 / math.sqrt(own.n - 3)
    assert (own.low, own.high) == pytest.approx((math.tanh(math.atanh(r) - half), math.tanh(math.atanh(r) + half)))
    assert 0 < own.p < 1e-3
    assert got["a", "c"].r is None or math.isnan(got["a", "c"].r)
    whole = st.correlation_test(frame.where("b is not null"), "a", "b").first()
    assert whole.t == pytest.approx(own.t)
    test = {x.value: x for x in st.welch_tests(frame, ["v", "b", "c"], "g").collect()}
    one = st.welch_t(frame, "v", "g").first()
    assert (test["v"].t, test["v"].df, test["v"].mean1) == pytest.approx((one.t, one.df, one.mean1))
    # The bounds touch 0 exactly where the probability is 5 %.
    assert (test["v"].low <= 0 <= test["v"].high) == (test["v"].p >= 0.05)
    assert test["v"].low + test["v"].high == pytest.approx(2 * (test["v"].mean1 - test["v"].mean2))
    assert test["c"].t is None and test["c"].p is None
    few = st.welch_tests(frame.limit(1), ["v"], "g").first()
    assert few.t is None and few.p is None


def test_density_is_that_of_the_plain_sum(spark):
    """Against kernels laid over every single value; binning costs less than a thousandth of the highest density."""
    draw = random.Random(3)
    rows = [("x", draw.gauss(0, 1)) for _ in range(400)] + [("y", draw.expovariate(1)) for _ in range(150)] + [("one", 0.5), ("same", 2.0), ("same", 2.0)]
    rows += [(None, draw.random()) for _ in range(30)] + [("x", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = st.class_density(frame, "v", "k").collect()
    low, high = min(v for _, v in rows if v is not None), max(v for _, v in rows if v is not None)
    for k in {k for k, _ in rows}:
        values = sorted(v for c, v in rows if c == k and v is not None)
        own = sorted((r for r in got if r.k == k), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(512))
        assert own[0].x == pytest.approx(low) and own[-1].x == pytest.approx(high)
        if len(values) > 2:
            quarter = statistics.quantiles(values, n=4, method="inclusive")
            h = 0.9 * min(statistics.stdev(values), (quarter[2] - quarter[0]) / 1.34) * len(values) ** -0.2
        else:
            h = 0.9 * len(values) ** -0.2
        assert own[0].bandwidth == pytest.approx(h)
        scale = 1 / (len(values) * h * math.sqrt(2 * math.pi))
        want = [scale * sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in values) for r in own]
        assert max(abs(r.density - w) for r, w in zip(own, want, strict=True)) < 1e-3 * max(want)
    assert st.class_density(frame.limit(0), "v", "k").collect() == []
    flat = st.class_density(spark.createDataFrame([("a", 1.0), ("a", 1.0)], "k string, v double"), "v", "k").collect()
    assert len(flat) == 512 and all(math.isfinite(r.density) for r in flat)
