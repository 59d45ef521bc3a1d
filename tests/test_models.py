import random

import numpy as np
import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from tremora.operators import folds, models
from tremora.plans import chain
from tremora.sources import stages


def table(spark, n=200, seed=0):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        a, b = rng.gauss(5, 2), rng.random()
        data.append((i, at(i // 3), a, b, 2 * a - 3 * b + rng.gauss(0, 0.1), 4.0))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id long, datetime timestamp_ntz, a double, b double, y_rating double, k_rating double")


@pytest.mark.parametrize("n,k", [(10, 3), (200, 3), (13, 5), (4, 3)])
def test_time_folds(spark, n, k):
    got = folds.time_folds(table(spark, n).repartition(7), ["datetime", "id"], k).orderBy("row_index").collect()
    assert [r.id for r in got] == list(range(n)) and [r.row_index for r in got] == list(range(n))
    size = n // (k + 1)
    want = [None] * (n - k * size) + [i for i in range(k) for _ in range(size)]
    assert [r.test_fold for r in got] == want
    first = folds.training_rows(folds.time_folds(table(spark, n), ["datetime", "id"], k), 0).count()
    assert first == n - k * size


def test_too_few_rows(spark):
    with pytest.raises(ValueError):
        folds.time_folds(table(spark, 3), ["datetime", "id"], 3)
    with pytest.raises(ValueError):
        folds.time_folds(table(spark, 3).where("false"), ["datetime", "id"], 3)


def test_baseline_mean(spark):
    folded = folds.time_folds(table(spark, 40), ["datetime", "id"])
    ys = [r.y_rating for r in folded.orderBy("row_index").collect()]
    got = rows(folds.baseline_mean(folded, "y_rating"), "fold")
    assert got == [(i, pytest.approx(np.mean(ys[:10 * (i + 1)]))) for i in range(3)]


def test_cv_summary_numbers(spark):
    df = spark.createDataFrame([("t", "m", 0, 4.0, 2.0, 0.8, 0.7), ("t", "m", 1, 9.0, 3.0, 0.6, 0.5)],
                               ["target", "model", "fold", "MSE", "MAE", "R2", "Explained Variance"])
    r = folds.cv_summary(df).first()
    assert (r.MSE, r.RMSE, r.MAE, r.R2, r["Explained Variance"]) == pytest.approx((6.5, 2.5, 2.5, 0.7, 0.6))


def test_fold_metrics(spark):
    y, p = [1.0, 2.0, 4.0], [1.5, 2.0, 3.0]
    data = [("t", "m", 0, a, b) for a, b in zip(y, p)]
    data += [("k", "right", 0, 7.0, 7.0)] * 2 + [("k", "off", 0, 7.0, 6.0)] * 2
    r = {x.model: x for x in folds.fold_metrics(spark.createDataFrame(data, "target string, model string, fold int, y double, prediction double")).collect()}
    e, y = np.array(y) - np.array(p), np.array(y)
    assert r["m"].MSE == pytest.approx((e**2).mean()) and r["m"].MAE == pytest.approx(abs(e).mean())
    assert r["m"].R2 == pytest.approx(1 - (e**2).mean() / y.var())
    assert r["m"]["Explained Variance"] == pytest.approx(1 - e.var() / y.var())
    assert (r["right"].R2, r["right"]["Explained Variance"]) == (1.0, 1.0)
    # a constant miss has no error variance
    assert (r["off"].R2, r["off"]["Explained Variance"]) == (0.0, 1.0)


def test_select_best_first_wins_ties(spark):
    df = spark.createDataFrame([("t", "b", 0.5), ("t", "a", 0.5), ("u", "a", None), ("u", "b", -3.0)], "target string, model string, R2 double")
    assert {(r.target, r.model) for r in folds.select_best(df, ["a", "b"]).collect()} == {("t", "a"), ("u", "b")}


def test_standardise_uses_training_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (7.0, 5.0)], "a double, k double")
    got = rows(models.standardise(df, ["a", "k"], df.where("a < 5")))
    assert got == [(-1.0, 0.0), (1.0, 0.0), (5.0, 0.0)]


def test_poly(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "x double, y double")
    assert models.poly_features(df, ["x", "y"]).first().poly == [2.0, 4.0, 3.0, 6.0, 9.0]
    assert len(models.poly_features(df, ["x", "y"], 5).first().poly) == 20


@pytest.mark.parametrize("alpha", [0.01, 50.0])
def test_ridge_matches_closed_form(spark, alpha):
    df = table(spark)
    fitted = models.fit(df, ["a", "b"], "y_rating", "Ridge", {"alpha": alpha})
    local = df.toPandas()
    x = local[["a", "b"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    y = local["y_rating"].to_numpy()
    w = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean()))
    np.testing.assert_allclose(fitted.stages[-1].coefficients.toArray(), w, rtol=1e-6)
    got = models.predict(fitted, df).orderBy("id").toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(got, (z @ w + y.mean())[np.argsort(local["id"])], rtol=1e-6)


@pytest.mark.parametrize("model,params", [
    ("Baseline", {}), ("PolyRidgeDegree2", {}), ("RandomForest", {"n_estimators": 5, "max_depth": 4}),
    ("GradientBoosting", {"n_estimators": 5, "max_depth": 3}), ("KernelRidge", {"components": 32, "C": 100.0}), ("RuleTree", {}),
])
def test_models_fit_and_reload(spark, tmp_path, model, params):
    df = table(spark)
    fitted = models.fit(df, ["a", "b"], "y_rating", model, params)
    mse = models.predict(fitted, df).agg(F.avg((F.col("y_rating") - F.col("prediction")) ** 2)).first()[0]
    spread = df.agg(F.var_pop("y_rating")).first()[0]
    assert mse == pytest.approx(spread) if model == "Baseline" else mse < 0.6 * spread
    fitted.write().save(str(tmp_path / "m"))
    again = type(fitted).load(str(tmp_path / "m"))
    assert rows(models.predict(again, df), "id") == rows(models.predict(fitted, df), "id")


def test_poly_ridge_matches_closed_form(spark):
    df = table(spark)
    fitted = models.fit(df, ["a", "b"], "y_rating", "PolyRidgeDegree2", {"alpha": 3.0})
    local = df.orderBy("id").toPandas()
    x = local[["a", "b"]].to_numpy()
    a, b = ((x - x.mean(0)) / x.std(0)).T
    z = np.column_stack([a, a * a, b, a * b, b * b])
    y, c = local["y_rating"].to_numpy(), z - z.mean(0)
    w = np.linalg.solve(c.T @ c + 3.0 * np.eye(5), c.T @ (y - y.mean()))
    got = models.predict(fitted, df).orderBy("id").toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(got, c @ w + y.mean(), rtol=1e-6)


def test_rule_text_and_names(spark):
    fitted = models.fit(table(spark), ["a", "b"], "y_rating", "RuleTree")
    assert "If (feature 0 <=" in models.rule_text(fitted)
    with pytest.raises(ValueError):
        models.fit(table(spark), ["a"], "y_rating", "Other")


def test_draws_are_seeded_and_in_range():
    a, b = models.draw_params("GradientBoosting", 10, 1), models.draw_params("GradientBoosting", 10, 1)
    assert a == b and a != models.draw_params("GradientBoosting", 10, 2)
    assert all(50 <= d["n_estimators"] < 150 and d["max_depth"] in (3, 4, 5) and 0.01 <= d["learning_rate"] <= 0.1 for d in a)
    assert models.draw_params("Baseline", 2) == [{}, {}]


def test_random_search(spark):
    folded = folds.time_folds(table(spark), ["datetime", "id"])
    best, draws = models.random_search(folded, ["a", "b"], "y_rating", "Ridge", n=4)
    scores = {r.model: r.R2 for r in draws.collect()}
    assert len(scores) == 4
    assert best == models.draw_params("Ridge", 4)[int(max(sorted(scores), key=scores.get))]


def test_ridge_search_agrees_with_fitted_models(spark):
    df = table(spark).withColumn("flat", F.lit(2.0))
    folded = folds.time_folds(df, ["datetime", "id"])
    features = ["a", "b", "flat"]
    got = {r.model: r for r in models.random_search(folded, features, "y_rating", "Ridge", n=3)[1].collect()}
    for d, params in enumerate(models.draw_params("Ridge", 3)):
        parts = []
        for i in range(3):
            fitted = models.fit(folds.training_rows(folded, i), features, "y_rating", "Ridge", params)
            parts.append(models.predict(fitted, folds.test_rows(folded, i)).select(
                F.lit("t").alias("target"), F.lit("m").alias("model"), F.lit(i).alias("fold"), F.col("y_rating").alias("y"), "prediction"))
        want = folds.cv_summary(folds.fold_metrics(parts[0].unionByName(parts[1]).unionByName(parts[2]))).first()
        for c in folds.SCORES:
            assert got[f"{d:02d}"][c] == pytest.approx(want[c], rel=1e-6)


def test_encode_categories(spark):
    train = spark.createDataFrame([("a",), ("b",)], "location string")
    model = models.encode_categories(["location"]).fit(train)
    got = model.transform(spark.createDataFrame([("b",), (None,)], "location string")).collect()
    assert len(got[0].location_hot) == 4 and got[1].location_hot.toArray()[2] == 1


def test_regression_table_and_columns(spark):
    df = table(spark, 5).withColumn("filepath", F.lit("x")).withColumn("location", F.lit("l")).withColumn("bucket_id", F.lit(1))
    out = chain.regression_table(df, categories={"location": ["l", "m"]})
    assert "filepath" not in out.columns and "bucket_id" not in out.columns
    features, targets = chain.split_columns(out, keep=["id"])
    assert features == ["a", "b", "datetime_ts", "loc_l", "loc_m"] and targets == ["y_rating", "k_rating"]


def test_train_and_save(spark, tmp_path):
    done = chain.train(table(spark), ["a", "b"], ["y_rating", "k_rating"], ["datetime", "id"], ["Baseline", "Ridge", "RuleTree"])
    best = {r.target: r for r in done.best.collect()}
    assert best["y_rating"].model == "Ridge" and best["y_rating"].R2 > 0.9
    assert best["k_rating"].model == "Baseline" and best["k_rating"].R2 == 1.0
    stored = stages.save_best(done.models, done.best, done.predictions, str(tmp_path), "8#Belt Conveyer")
    assert stored.count() == 2 and stored.first().device == "8#Belt Conveyer"
    again = stages.load_best(str(tmp_path), "8#Belt Conveyer", "y_rating")
    assert models.predict(again, table(spark)).count() == 200
    assert stages.load_predictions(spark, str(tmp_path), "8#Belt Conveyer", "k_rating").agg(F.max("prediction")).first()[0] == 4.0
    assert done.predictions.columns == ["datetime", "id", "target", "y", "prediction"]
    assert done.predictions.groupBy("target").count().collect()[0]["count"] == 200


def test_a_model_competes_with_itself(spark):
    own = {"two": ("PolyRidgeDegree2", {"degree": 2}), "five": ("PolyRidgeDegree2", {"degree": 5}), "flat": ("Baseline", {})}
    done = chain.train(table(spark, 80), ["a", "b"], ["y_rating"], ["datetime", "id"], own)
    assert {r.model for r in done.scores.collect()} == set(own)
    assert done.best.first().model in ("two", "five") and done.predictions.count() == 80


def test_train_with_search(spark):
    done = chain.train(table(spark, 60), ["a", "b"], ["y_rating"], ["datetime", "id"], ["Ridge", "RuleTree"], tune=True, draws=2)
    assert done.scores.count() == 2


def test_targets_draws_and_folds_share_one_binned_table(spark, monkeypatch):
    made = []
    real = models.binned
    monkeypatch.setattr(models, "binned", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    monkeypatch.setitem(models.SEARCH_SPACE, "RandomForest", {"n_estimators": ("int", 2, 5), "max_depth": ("int", 2, 4)})
    df = table(spark).withColumn("z_rating", F.col("a") * 3)
    done = chain.train(df, ["a", "b"], ["y_rating", "z_rating"], ["datetime", "id"],
                       {"f": ("RandomForest", {}), "g": ("GradientBoosting", {"n_estimators": 3, "max_depth": 2})}, tune=False)
    best, draws = models.random_search(folds.time_folds(df, ["datetime", "id"]), ["a", "b"], "y_rating", "RandomForest", 3)
    assert len(made) == 2 and draws.count() == 3  # one for the training, one for the search
    assert set(made[0].rows.columns) == {"test_fold", "y_rating", "z_rating", "_x"} and made[0].rows.count() == 200
    assert done.predictions.count() == 400 and all(r.R2 > 0.5 for r in done.best.collect())


@pytest.mark.parametrize("model", models.FORESTS)
def test_binned_trees_equal_trees_on_few_values(spark, tmp_path, model):
    """With fewer values than bins nothing is lost; flags, rare values and constants keep their splits."""
    df = table(spark).select("id", "datetime", F.floor("a").cast("double").alias("a"), (F.col("id") % 50 == 0).alias("flag"),
                             F.lit(1).alias("one"), (F.floor("a") * 2 + F.when(F.col("id") % 50 == 0, 40.0).otherwise(0.0)).alias("y"))
    features, params = ["a", "flag", "one"], {"n_estimators": 3, "max_depth": 4, "learning_rate": 0.5}
    matrix = models.binned(folds.time_folds(df, ["datetime", "id"]), features, ["y"])
    fitted = models.fit_binned(matrix, matrix.rows, "y", model, params)
    assert not matrix.rows.schema["_x"].metadata and " in {" not in models.rule_text(fitted) and "<=" in models.rule_text(fitted)
    error = models.predict(fitted, df).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    plain = models.predict(models.fit(df, features, "y", model, params), df).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error == pytest.approx(plain, rel=0.35, abs=0.1)
    fitted.write().save(str(tmp_path / "m"))
    assert rows(models.predict(type(fitted).load(str(tmp_path / "m")), df), "id") == rows(models.predict(fitted, df), "id")


def test_borders():
    assert models._borders(np.array([0.0, 0, 0, 1]), 32) == [0.5] and models._borders(np.array([2.0, 2]), 32) == [2.0]
    assert models._borders(np.array([]), 32) == [0.0]
    many = models._borders(np.arange(1000.0), 32)
    assert len(many) == 31 and many == sorted(set(many))


def test_random_cosines_approach_the_kernel(spark):
    cosines = models.RandomCosines()
    cosines._set(width=2, components=4000, gamma=0.5, seed=3)
    points = np.array([[0.0, 0.0], [1.0, 0.5], [-1.0, 2.0]])
    df = spark.createDataFrame([(i, models.np.asarray(p).tolist()) for i, p in enumerate(points)], "id int, v array<double>")
    got = cosines.transform(df.select("id", models.array_to_vector("v").alias("_z"))).orderBy("id").collect()
    x = np.array([r._x.toArray() for r in got])
    want = np.exp(-0.5 * ((points[:, None] - points[None]) ** 2).sum(-1))
    np.testing.assert_allclose(x @ x.T, want, atol=0.06)


def test_a_task_of_a_tree_fit_holds_few_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 50)
    data = [(i, float(i % 5), float(i % 3), float(i % 7)) for i in range(2000)]
    table = folds.time_folds(spark.createDataFrame(data, "id long, a double, b double, y double"), ["id"])
    matrix = models.binned(table, ["a", "b"], ["y"])
    forest = models._points(matrix, matrix.rows, "y", "RandomForest")
    sizes = [n for n in forest.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert sum(sizes) == 2000 and max(sizes) < 100
    cells = models._points(matrix, matrix.rows, "y", "GradientBoosting")
    assert cells.count() == 15 and cells.agg(F.sum("_weight"), F.sum(F.col("_weight") * F.col("y"))).first() == (2000.0, sum(r[3] for r in data))


def test_kernel_ridge_matches_closed_form_from_sums(spark):
    df = table(spark)
    fitted = models.fit(df, ["a", "b"], "y_rating", "KernelRidge", {"components": 16, "C": 10.0})
    ridge = fitted.stages[-1]
    assert isinstance(ridge, models.CosineRidge)  # features of a batch go into sums, not into vectors of Spark
    local = df.orderBy("id").toPandas()
    x, y = local[["a", "b"]].to_numpy(), local["y_rating"].to_numpy()
    wide = ridge.basis()((x - x.mean(0)) / x.std(0))
    c = wide - wide.mean(0)
    w = np.linalg.solve(c.T @ c + 0.1 * np.eye(16), c.T @ (y - y.mean()))
    got = models.predict(fitted, df).orderBy("id").toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(got, c @ w + y.mean(), rtol=1e-6)
    with pytest.raises(Exception, match="null or NaN"):
        models.fit(df.withColumn("b", F.when(F.col("id") > 3, F.col("b"))), ["a", "b"], "y_rating", "KernelRidge")


def test_predictions_of_a_target_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    df = table(spark, 80).withColumnRenamed("k_rating", "k: 50%")
    done = chain.train(df, ["a", "b"], ["y_rating", "k: 50%"], ["datetime", "id"], ["Baseline", "Ridge"])
    one = done.predictions.where(F.col("target") == "y_rating")
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan  # the other target's part is gone
    more = done.predictions.unionByName(done.predictions.limit(3).withColumn("target", F.lit("other")))
    for _ in range(2):  # a second run replaces the first
        stages.save_best(done.models, done.best, more, str(tmp_path), "d")
    base = tmp_path / "predictions" / "d"
    assert sorted(p.name for p in base.iterdir() if p.is_dir()) == ["target=k%3A 50%25", "target=other", "target=y_rating"]
    read = spark.read.parquet(str(base)).select(*more.columns)
    assert rows(read) == rows(more)
    assert stages.load_predictions(spark, str(tmp_path), "d", "k: 50%").count() == 80
