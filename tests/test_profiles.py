import random

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tremora.operators import profiles, quantiles as qs, reshape


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    # one location holds most rows, and one value most of them
    data = [("hot" if rng.random() < 0.8 else f"l{rng.randrange(3)}", rng.choice([1.0, 1.0, 1.0, rng.gauss(0, 5)]),
             None if rng.random() < 0.3 else rng.expovariate(1)) for _ in range(3000)]
    return pd.DataFrame(data, columns=["location", "x", "y"]), spark.createDataFrame(data, "location string, x double, y double")


@pytest.mark.parametrize("limit", [10**6, 10])
def test_quantiles_by_key(frame, limit):
    pdf, df = frame
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {(r.location, r.feature): (r.n, r.q) for r in qs.quantiles(df, ["x", "y"], probs, ["location"], limit).collect()}
    for (loc, part) in pdf.groupby("location"):
        for c in ("x", "y"):
            n, q = got[loc, c]
            assert n == part[c].count()
            np.testing.assert_allclose(q, part[c].quantile(list(probs)).to_numpy(), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("limit", [10**6, 10])
def test_quantiles_whole_table(frame, limit):
    pdf, df = frame
    got = {r.feature: r.q for r in qs.quantiles(df, ["x", "y"], (0.25, 0.75), in_memory_rows=limit).collect()}
    for c in ("x", "y"):
        np.testing.assert_allclose(got[c], pdf[c].quantile([0.25, 0.75]).to_numpy(), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert qs.quantiles(df, ["x"], (0.5,)).count() == 0


@pytest.mark.parametrize("limit", [10**6, 10])
def test_iqr_filter_is_sequential(frame, limit):
    pdf, df = frame
    for c in ("y", "x"):
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        pdf = pdf[(pdf[c] >= q1 - 1.5 * (q3 - q1)) & (pdf[c] <= q3 + 1.5 * (q3 - q1))]
    assert profiles.iqr_filter(df, ["y", "x"], limit).count() == len(pdf)


def test_histogram_matches_numpy(spark):
    values = [0.0, 0.1, 1.0, 2.5, 3.0, 3.0, None]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 4.0)], "location string, x double")
    got = profiles.histogram(df, ["x"], ["location"]).orderBy("location", "bin").toPandas()
    for loc, vals in (("a", values[:-1]), ("b", [4.0])):
        counts, edges = np.histogram(vals, bins=30)
        part = got[got.location == loc]
        assert list(part["n"]) == list(counts)
        np.testing.assert_allclose(part["bin_start"], edges[:-1], atol=1e-12)
        np.testing.assert_allclose(part["bin_end"], edges[1:])


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 5.0), ("c", None)], "location string, x double")
    got = {r.location: r for r in profiles.box_stats(df, ["x"], ["location"]).collect()}
    a = got["a"]
    assert (a.q1, a.median, a.q3, a.whisker_low, a.whisker_high, a.n_outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert (got["b"].whisker_low, got["b"].whisker_high, got["b"].n_outliers) == (5.0, 5.0, 0)
    assert "c" not in got


def test_correlations(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, None], "b": [2.0, 1, None, 5, 6], "k": [7.0] * 5, "e": [None] * 5}).astype(float)
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)], "a double, b double, k double, e double")
    want = pdf.corr(min_periods=2)
    got = {(r.x, r.y): r["corr"] for r in profiles.corr_matrix(df, ["a", "b", "k", "e"]).collect()}
    assert len(got) == 16
    assert got["a", "b"] == pytest.approx(want.loc["a", "b"]) and got["b", "a"] == got["a", "b"]
    assert got["a", "a"] == pytest.approx(1.0)
    assert got["a", "k"] is None and got["k", "k"] is None and got["a", "e"] is None
    with pytest.raises(ValueError):
        profiles.corr_cross(df, ["a"], ["nope"])


def test_profile(spark):
    df = spark.createDataFrame([("x", 1.0), (None, 3.0), ("y", None)], "s string, v double")
    got = {r["column"]: r for r in profiles.profile(df, ["v"]).collect()}
    assert (got["s"].n_rows, got["s"].n_null, got["s"].dtype, got["s"]["mean"]) == (3, 1, "string", None)
    v = got["v"]
    assert (v.n_null, v["mean"], v["min"], v["max"], v.q25, v.q50, v.q75, v.n_columns) == (1, 2.0, 1.0, 3.0, 1.5, 2.0, 2.5, 2)


def test_radar_skips_missing_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert rows(profiles.radar_means(df, ["a", "b", "nope"])) == sorted([("a", 2.0), ("b", None)], key=repr)
    assert profiles.radar_means(df.where("false"), ["a"]).count() == 0
    assert profiles.radar_means(df, ["nope"]).count() == 0


def test_pair_points(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "a long, b double, t double")
    assert rows(reshape.pair_points(df, ["a", "b"], ["t"])) == [("a", 1.0, "t", 3.0), ("b", 2.0, "t", 3.0)]
    assert rows(reshape.to_long(df, ["a", "nope"])) == [("a", 1.0)]


def test_correlations_of_many_columns(spark):
    """Two hundred columns with gaps and far-off means, beside pandas."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 200)) * rng.uniform(0.1, 10, 200) + rng.uniform(-1e6, 1e6, 200)
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=400)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.25
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(200)])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"c{i} double" for i in range(200))).repartition(5)
    got = {(r.x, r.y): r.corr for r in profiles.corr_matrix(df, list(pdf.columns)).collect()}
    assert len(got) == 200 * 200
    want = pdf.corr()
    for i in (0, 1, 5, 7, 100, 199):
        for j in (0, 1, 7, 50, 199):
            a, b = f"c{i}", f"c{j}"
            if 7 in (i, j):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)


def test_grouped_products(spark):
    from tremora.operators.gram import grouped_products

    rng = np.random.default_rng(1)
    x, g = rng.normal(size=(300, 4)), rng.integers(-1, 3, 300)
    rows_ = [(*map(float, r), None if k < 0 else int(k)) for r, k in zip(x, g)]
    df = spark.createDataFrame(rows_, "a double, b double, c double, d double, fold int").repartition(4)
    got = grouped_products(df, list("abcd"), [1.0, 0, 0, 0], [2.0, 1, 1, 1], "fold", 3)
    z = np.concatenate([(x - [1, 0, 0, 0]) / [2, 1, 1, 1], np.ones((300, 1))], axis=1)
    for k in range(-1, 3):
        assert np.allclose(got[k + 1], z[g == k].T @ z[g == k])


def test_selected_quantiles_equal_percentile(spark):
    """Ties, nulls, both infinities, subnormal and huge values, a constant and an empty column; few bins, so many passes."""
    rng = random.Random(0)
    inf = float("inf")
    wide = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(300)] + [5e-324, -5e-324, 1.7e308, -1.7e308]
    ties = [float(rng.choice([0, 0, 0, 1, 2])) for _ in wide]
    data = [(w, t, None if i % 3 else w, 4.0, None, inf if i == 7 else -inf if i == 8 else t) for i, (w, t) in enumerate(zip(wide, ties))]
    df = spark.createDataFrame(data, "w double, t double, n double, c double, e double, i double").repartition(4)
    probs = (0.0, 0.01, 0.5, 0.75, 1.0)
    want = {r.feature: (r.n, r.q) for r in qs.quantiles(df, ["w", "t", "n", "c", "i"], probs).collect()}
    for bins in (16, 1024):
        got = {r.feature: (r.n, r.q) for r in qs.selected_quantiles(df, ["w", "t", "n", "c", "e", "i"], probs, bins).collect()}
        assert set(got) == set(want)
        for c in want:
            assert got[c][0] == want[c][0]
            for a, b in zip(got[c][1], want[c][1]):
                assert a == b or abs(a - b) <= 1e-12 * abs(b), c


def test_selected_quantiles_make_no_row_per_value(spark, monkeypatch):
    """A pass sorts batches in place; it once made a row of every value and interval."""
    n, plans = 40_000, []
    df = spark.range(0, n, 1, 4).selectExpr("cast(pmod(id * 7919, 40000) as double) as a", "id / 7 - 2000 as b", "if(id % 9 = 0, double('NaN'), exp(id / 100)) as c")
    frame, collect = type(df), type(df).collect
    monkeypatch.setattr(frame, "collect", lambda self: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or collect(self))
    got = {r.feature: (r.n, r.q) for r in qs.selected_quantiles(df, list("abc"), (0.0, 0.3, 0.77, 1.0), 16).collect()}
    assert len(plans) > 3 and not any("Generate" in p for p in plans)
    at = np.arange(n)
    for c, x in zip("abc", (at * 1.0, at / 7 - 2000, np.where(at % 9 == 0, np.nan, np.exp(at / 100)))):
        x = np.sort(x)  # NaN last
        assert got[c][0] == n
        np.testing.assert_allclose(got[c][1], [x[k] + (x[m] - x[k]) * (p * (n - 1) - k) if k != m else x[k]
                                               for p in (0.0, 0.3, 0.77, 1.0) for k, m in [(int(np.floor(p * (n - 1))), int(np.ceil(p * (n - 1))))]], rtol=1e-12)


def test_selected_quantiles_of_neighbouring_doubles(spark):
    """Values with no double between them, and every rank asked for."""
    for first in (1.0, -1.0, 5e-324, -1.7e308):
        x = [first]
        for _ in range(6):
            x.append(float(np.nextafter(x[-1], np.inf)))
        df = spark.createDataFrame([(v,) for v in x for _ in range(2)], "x double")
        got = qs.selected_quantiles(df, ["x"], [k / 13 for k in range(14)], 3).first()
        assert got.n == 14
        for k, v in enumerate(got.q):
            assert x[max(0, k // 2 - 1)] <= v <= x[min(6, k // 2 + 1)]
        assert got.q[0] == x[0] and got.q[13] == x[6]


def test_sketches_merge(spark):
    df = spark.range(20_000).selectExpr("id % 4 as part", "cast(id as double) as v", "cast(null as double) as e")
    parts = qs.value_sketches(df, ["v", "e"], ["part"], 200)
    assert rows(parts.select("part", "feature", "n")) == [(p, "v", 5000) for p in range(4)]
    n, q = qs.sketched_quantiles(qs.merged_sketches(parts), (0.1, 0.5, 0.9)).select("n", "q").first()
    assert n == 20_000
    for p, v in zip((0.1, 0.5, 0.9), q):
        assert abs(v / 20_000 - p) <= 2 * qs.rank_error(200)


def test_pair_points_of_few_rows(spark):
    df = spark.range(500).selectExpr("id", "id * 2.0 as a", "id * 3.0 as t")
    few = rows(reshape.pair_points(df, ["a"], ["t"], ["id"], 20))
    assert len(few) == 20 and few == rows(reshape.pair_points(df.repartition(7), ["a"], ["t"], ["id"], 20))
    assert reshape.pair_points(df, ["a"], ["t"], ["id"], None).count() == 500
    assert reshape.pair_points(df, ["a"], ["t"], rows=3).count() == 3
