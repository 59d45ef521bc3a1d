"""Regressors as Spark ML pipelines over plain numeric columns.

Every pipeline carries its own standardisation, fitted on the rows it trains on, so
a saved model scores raw columns. Forests and boosted trees can share one stored matrix of
binned features (``binned``); their pipelines then carry the bins.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, OneHotEncoder, PolynomialExpansion, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from tremora.operators.folds import cv_summary, fold_metrics, test_rows, training_rows
from tremora.operators.gram import expanded_products, grouped_products
from tremora.session import materialise

MODELS = (
    "Baseline", "Ridge", "PolyRidgeDegree2", "RandomForest", "GradientBoosting", "KernelRidge", "RuleTree",
)

# Defaults and search ranges per model.
DEFAULTS: dict[str, dict[str, Any]] = {
    "Baseline": {},
    "Ridge": {"alpha": 1.0},
    "PolyRidgeDegree2": {"alpha": 1.0, "degree": 2},
    "RandomForest": {"n_estimators": 100, "max_depth": 10},
    "GradientBoosting": {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1},
    "KernelRidge": {"C": 1.0, "gamma": "scale", "components": 64},
    "RuleTree": {"max_depth": 1},
}
SEARCH_SPACE: dict[str, dict[str, tuple]] = {
    "Ridge": {"alpha": ("log", 1e-3, 1e3)},
    "PolyRidgeDegree2": {"alpha": ("log", 1e-3, 1e3)},
    "RandomForest": {"n_estimators": ("int", 50, 200), "max_depth": ("int", 3, 20)},
    "GradientBoosting": {
        "n_estimators": ("int", 50, 150), "max_depth": ("one", 3, 4, 5), "learning_rate": ("log", 0.01, 0.1),
    },
    "KernelRidge": {"C": ("log", 1e-2, 1e2), "gamma": ("one", "scale", "auto")},
    "RuleTree": {"max_depth": ("int", 1, 3)},
}


@dataclass
class Scaling:
    """Number of rows, mean and population standard deviation per feature, and of the target."""

    rows: int
    moments: dict[str, tuple[float, float]]
    target: tuple[float, float] | None = None


def scaling(df: DataFrame, features: Sequence[str], target: str | None = None) -> Scaling:
    """Statistics of the training rows in one pass; a constant feature divides by 1."""
    columns = [*features, *([target] if target else [])]
    pairs = [f(F.col(f"`{c}`")) for c in columns for f in (F.avg, F.stddev_pop)]
    n, *row = df.agg(F.count(F.lit(1)), *pairs).first()
    if not n:
        raise ValueError("no rows to train on")
    moments = {c: (row[2 * i], row[2 * i + 1] or 1.0) for i, c in enumerate(features)}
    return Scaling(n, moments, (row[-2], row[-1]) if target else None)


def standardise(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Centre and scale the features by statistics of ``fit_on`` (the training rows)."""
    stats = scaling(df if fit_on is None else fit_on, features)
    return df.withColumns({c: (F.col(f"`{c}`") - m) / s for c, (m, s) in stats.moments.items()})


def poly_features(df: DataFrame, features: Sequence[str], degree: int = 2, out: str = "poly") -> DataFrame:
    """Powers and products up to ``degree`` without a constant, as an array column."""
    vector = VectorAssembler(inputCols=list(features), outputCol="_v").transform(df)
    expanded = PolynomialExpansion(degree=degree, inputCol="_v", outputCol="_p").transform(vector)
    return expanded.withColumn(out, vector_to_array("_p")).drop("_v", "_p")


def _scaled_names(features: Sequence[str]) -> list[str]:
    return [f"_z{i}" for i in range(len(features))]


def _scale_stage(stats: Scaling) -> SQLTransformer:
    terms = [f"(`{c}` - ({m!r}D)) / {s!r}D AS _z{i}" for i, (c, (m, s)) in enumerate(stats.moments.items())]
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


class RandomCosines(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Random cosine features ``_x`` of the vector ``_z``; their inner products approach an RBF kernel.

    One matrix product a batch. Directions and phases are drawn from the seed, so a saved
    model holds four numbers, whatever its size.
    """

    width = Param(Params._dummy(), "width", "length of the vector", TypeConverters.toInt)
    components = Param(Params._dummy(), "components", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "of the kernel exp(-gamma |a - b|^2)", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of directions and phases", TypeConverters.toInt)

    def basis(self) -> Callable[[np.ndarray], np.ndarray]:
        """From rows of the vector to rows of features."""
        width, components = self.getOrDefault("width"), self.getOrDefault("components")
        rng, spread = random.Random(self.getOrDefault("seed")), math.sqrt(2 * self.getOrDefault("gamma"))
        drawn = np.array([[*(rng.gauss(0, spread) for _ in range(width)), rng.uniform(0, 2 * math.pi)] for _ in range(components)])
        directions, phases, height = drawn[:, :-1].T, drawn[:, -1], math.sqrt(2 / components)
        return lambda z: height * np.cos(z @ directions + phases)

    def _transform(self, df: DataFrame) -> DataFrame:
        basis = self.basis()

        @F.pandas_udf("array<double>")
        def cosines(z: pd.Series) -> pd.Series:
            return pd.Series(list(basis(np.stack(z))) if len(z) else [], dtype=object)

        return df.withColumn("_x", array_to_vector(cosines(vector_to_array("_z"))))


class CosineRidge(RandomCosines):
    """Ridge ``prediction`` on random cosine features of the columns ``_z0``, ``_z1``, ..., which never leave the batch."""

    weights = Param(Params._dummy(), "weights", "of the features", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "added to their sum", TypeConverters.toFloat)

    def fitted(self, rows: DataFrame, target: str, stats: Scaling, alpha: float) -> CosineRidge:
        """With the weights that minimise the sum of squares plus ``alpha`` |w|^2, from one pass of sums of products."""
        basis, components, names = self.basis(), self.getOrDefault("components"), _scaled_names(stats.moments)
        mean, unit = stats.target[0], stats.target[1] or 1.0

        def expand(x: np.ndarray) -> np.ndarray:
            return np.column_stack([basis(x[:, :-1]), (x[:, -1] - mean) / unit, np.ones(len(x))])

        m = expanded_products(rows, [*names, target], expand, components + 2)
        n, centre = m[-1, -1], m[-1, :-1] / m[-1, -1]
        cov = m[:-1, :-1] - n * np.outer(centre, centre)
        w = np.linalg.solve(cov[:-1, :-1] + alpha * np.eye(components), cov[:-1, -1]) * unit
        return self._set(weights=w.tolist(), intercept=float(mean + centre[-1] * unit - centre[:-1] @ w))

    def _transform(self, df: DataFrame) -> DataFrame:
        basis, weights, intercept = self.basis(), np.array(self.getOrDefault("weights")), self.getOrDefault("intercept")

        @F.pandas_udf("double")
        def score(*z: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in z])
            if np.isnan(x).any():
                raise ValueError("null or NaN in the features")
            return pd.Series(basis(x) @ weights + intercept)

        return df.withColumn("prediction", score(*[F.col(f"_z{i}") for i in range(self.getOrDefault("width"))]))


FORESTS = ("RandomForest", "GradientBoosting")
MAX_BINS = 32
BIN_SAMPLE = 10_000  # rows whose features place the borders of the bins
FIT_ROWS = 500_000  # rows that a task of a fit keeps as points, some 300 bytes each


@dataclass
class Binned:
    """Stages that bin raw features into the vector ``_x``, the stored rows that hold it, and their number."""

    stages: list[Transformer]
    rows: DataFrame
    size: int


def _borders(values: np.ndarray, bins: int) -> list[float]:
    """Between all values where they are few, else quantiles; a constant is a border itself."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return distinct.tolist() or [0.0]
    if len(distinct) <= bins:
        return np.unique((distinct[:-1] + distinct[1:]) / 2).tolist()
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])).tolist()


def binned(df: DataFrame, features: Sequence[str], targets: Sequence[str], bins: int = MAX_BINS) -> Binned:
    """Bin the features of rows from ``time_folds`` once, for the fits of all targets, draws and folds.

    The borders come from the features of about BIN_SAMPLE rows, drawn by a hash of the row
    number, all rows if they are fewer. Stored are ``test_fold``, the targets and the vector
    of bin numbers, of which Parquet's dictionaries make a few bits each.
    """
    size = df.count()
    share = min(1.0, BIN_SAMPLE / max(1, size))
    some = df.where(F.pmod(F.xxhash64("row_index"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = some.select(*[F.col(f"`{c}`").cast("double").alias(f"_c{i}") for i, c in enumerate(features)]).toPandas()
    names = list(sample.columns)
    cast = SQLTransformer(statement=f"SELECT *, {', '.join(f'CAST(`{c}` AS double) AS _c{i}' for i, c in enumerate(features))} FROM __THIS__")
    splits = [[-math.inf, *_borders(sample[c].dropna().to_numpy(), bins), math.inf] for c in names]
    cut = Bucketizer(splitsArray=splits, inputCols=names, outputCols=[f"_b{i}" for i in range(len(names))])
    stages = [cast, cut, VectorAssembler(inputCols=cut.getOutputCols(), outputCol="_x")]
    ordered = F.col("_x").alias("_x", metadata={})  # bins are ordered numbers to the trees, not categories
    matrix = PipelineModel(stages).transform(df).select("test_fold", *[F.col(f"`{c}`") for c in targets], ordered)
    return Binned(stages, materialise(matrix, "binned"), size)


def _tree(model: str, p: Mapping[str, Any], seed: int, **columns: str):
    if model == "RandomForest":
        return RandomForestRegressor(numTrees=p["n_estimators"], maxDepth=p["max_depth"], seed=seed, maxBins=MAX_BINS,
                                     featureSubsetStrategy="all", **columns)
    if model == "GradientBoosting":
        return GBTRegressor(maxIter=p["n_estimators"], maxDepth=p["max_depth"], stepSize=p["learning_rate"], seed=seed,
                            maxBins=MAX_BINS, **columns)
    return DecisionTreeRegressor(maxDepth=p["max_depth"], seed=seed, **columns)


def _points(matrix: Binned, rows: DataFrame, target: str, model: str) -> DataFrame:
    """What a fit on ``rows`` reads: ``_x``, the target and ``_weight``.

    Boosting sees rows of the same bins as one, with their mean and number: they always share a prediction, and
    splits depend on sums and counts alone. A forest draws every row for itself; its rows are dealt to
    tasks of about FIT_ROWS, in an order of their own, as Spark's trees keep a partition's rows as one block.
    """
    rows = rows.where(F.col(f"`{target}`").isNotNull())
    if model == "GradientBoosting":
        cells = rows.groupBy("_x").agg(F.avg(F.col(f"`{target}`").cast("double")).alias(target), F.count(F.lit(1)).cast("double").alias("_weight"))
        return cells.select(F.col("_x").alias("_x", metadata={}), F.col(f"`{target}`"), "_weight")
    if matrix.size > FIT_ROWS:
        parts = max(-(-matrix.size // FIT_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
        rows = rows.repartition(parts).sortWithinPartitions(F.xxhash64("_x"), target)
    return rows.withColumn("_weight", F.lit(1.0))


def fit_binned(matrix: Binned, rows: DataFrame, target: str, model: str, params: Mapping[str, Any] | None = None,
               seed: int = 42) -> PipelineModel:
    """Train one of FORESTS on ``rows``, some or all of ``matrix.rows``; the result scores raw rows."""
    p = {**DEFAULTS[model], **(params or {})}
    tree = _tree(model, p, seed, featuresCol="_x", labelCol=target, predictionCol="prediction", weightCol="_weight")
    return PipelineModel([*matrix.stages, tree.fit(_points(matrix, rows, target, model))])


def fit(df: DataFrame, features: Sequence[str], target: str, model: str,
        params: Mapping[str, Any] | None = None, seed: int = 42, stats: Scaling | None = None) -> PipelineModel:
    """Train one model; the result adds a ``prediction`` column to raw rows.

    ``stats`` passes in the scaling of these very rows where it is known already.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model}, expected one of {MODELS}")
    p = {**DEFAULTS[model], **(params or {})}
    rows = df.where(F.col(f"`{target}`").isNotNull())
    stats = stats or (None if model in ("RandomForest", "GradientBoosting", "RuleTree") else scaling(rows, features, target))
    if model == "Baseline":
        constant = SQLTransformer(statement=f"SELECT *, {stats.target[0]!r}D AS prediction FROM __THIS__")
        return PipelineModel([constant])
    z = _scaled_names(features)
    trees = model in ("RandomForest", "GradientBoosting", "RuleTree")  # splits do not depend on scale
    stages: list[Any] = [] if trees else [_scale_stage(stats)]
    inputs = list(features) if trees else z
    if model == "KernelRidge":
        # on standardised features both ways of choosing gamma come to one over their number
        gamma = 1.0 / len(features) if p["gamma"] in ("scale", "auto") else float(p["gamma"])
        cosines = CosineRidge()
        cosines._set(width=len(z), components=p["components"], gamma=gamma, seed=seed)
        return PipelineModel([*stages, cosines.fitted(stages[0].transform(rows), target, stats, 1.0 / p["C"])])
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_x"))
    column = "_x"
    if model == "PolyRidgeDegree2":
        stages.append(PolynomialExpansion(degree=p["degree"], inputCol="_x", outputCol="_xp"))
        column = "_xp"
    common = {"featuresCol": column, "labelCol": target, "predictionCol": "prediction"}
    if model in ("Ridge", "PolyRidgeDegree2"):
        # sum of squares plus alpha |w|^2, restated for a solver that averages the squares
        # and divides its penalty by the spread of the label
        stages.append(LinearRegression(
            regParam=p["alpha"] / stats.rows * stats.target[1], elasticNetParam=0.0, standardization=False, solver="normal", **common
        ))
    else:
        stages.append(_tree(model, p, seed, **common))
    return Pipeline(stages=stages).fit(rows)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select(*df.columns, "prediction")


def rule_text(model: PipelineModel) -> str:
    return model.stages[-1].toDebugString


def in_threads(tasks: Sequence[Callable[[], Any]], threads: int) -> list:
    """Small fits overlap on the cluster; each is a Spark job of its own."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def ridge_weights(df: DataFrame, features: Sequence[str], target: str, alphas: Mapping[str, float],
                  k: int) -> dict[tuple[int, str], tuple[np.ndarray, float]]:
    """Ridge weights on raw columns, and intercepts, per (fold, name) from one pass.

    Folds train on growing prefixes, so sums of products per fold segment, added up,
    give every fold's normal equations; strengths differ only in the small solve.
    """
    columns = [*features, target]
    every = scaling(df, columns)
    centre = np.array([every.moments[c][0] for c in columns])
    unit = np.array([every.moments[c][1] for c in columns])
    prefix = grouped_products(df, columns, centre, unit, "test_fold", k).cumsum(axis=0)
    out = {}
    for fold in range(k):
        m = prefix[fold]
        n, mean = m[-1, -1], m[-1, :-1] / m[-1, -1]
        cov = m[:-1, :-1] - n * np.outer(mean, mean)
        spread = np.sqrt(np.diag(cov)[:-1] / n)
        spread[spread < 1e-12] = 1.0
        gram = cov[:-1, :-1] / np.outer(spread, spread)
        moment = cov[:-1, -1] / spread
        for name, alpha in alphas.items():
            w = np.linalg.solve(gram + alpha * np.eye(len(features)), moment) / spread
            w = w * unit[-1] / unit[:-1]
            level = centre + mean * unit
            out[fold, name] = w, float(level[-1] - w @ level[:-1])
    return out


def _linear(features: Sequence[str], weights: np.ndarray, intercept: float) -> Column:
    return sum((F.col(f"`{c}`") * float(w) for c, w in zip(features, weights)), F.lit(intercept))


def cross_validate(df: DataFrame, features: Sequence[str], target: str,
                   candidates: Mapping[str, tuple[str, Mapping[str, Any]]], k: int = 3,
                   threads: int = 4, seed: int = 42, matrix: Binned | None = None) -> DataFrame:
    """Fold scores of each named candidate (model, params) on rows from ``time_folds``.

    All ridge candidates share one pass of sums; other models are fitted fold by fold,
    forests and boosted trees on one table of binned features (``matrix``, if it is there
    already). The test rows of a fold are scored by all candidates in one pass.
    """
    names = list(candidates)
    df = df.where(F.col(f"`{target}`").isNotNull())
    alphas = {n: p.get("alpha", DEFAULTS["Ridge"]["alpha"]) for n, (m, p) in candidates.items() if m == "Ridge"}
    ridges = ridge_weights(df, features, target, alphas, k) if alphas else {}
    jobs = [(i, name) for i in range(k) for name in names if name not in alphas]
    kinds = {candidates[name][0] for _, name in jobs}
    scaled = kinds - {*FORESTS, "RuleTree"}
    stats = [scaling(training_rows(df, i), features, target) for i in range(k)] if scaled else [None] * k
    matrix = matrix or (binned(df, features, [target]) if kinds & {*FORESTS} else None)

    def train(i: int, name: str):
        model, params = candidates[name]
        if model in FORESTS:
            return lambda: fit_binned(matrix, training_rows(matrix.rows, i), target, model, params, seed)
        return lambda: fit(training_rows(df, i), features, target, model, params, seed, stats[i])

    fitted = dict(zip(jobs, in_threads([train(*j) for j in jobs], threads)))
    out = None
    for i in range(k):
        scored = test_rows(df, i)
        for c, name in enumerate(names):
            kept = scored.columns
            if name in alphas:
                scored = scored.withColumn("prediction", _linear(features, *ridges[i, name]))
            else:
                scored = fitted[i, name].transform(scored)
            scored = scored.select(*[F.col(f"`{x}`") for x in kept], F.col("prediction").alias(f"_p{c}"))
        long = scored.select(
            F.lit(i).alias("fold"), F.col(f"`{target}`").cast("double").alias("y"),
            F.inline(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"_p{c}").alias("prediction")) for c, n in enumerate(names)])),
        )
        out = long if out is None else out.unionByName(long)
    return fold_metrics(out.withColumn("target", F.lit(target)))


def draw_params(model: str, n: int = 10, seed: int = 42, space: Mapping[str, tuple] | None = None) -> list[dict[str, Any]]:
    """Seeded draws from the model's search space, or from one of one's own."""
    rng = random.Random(f"{seed}-{model}")
    def one(kind: str, *args):
        if kind == "log":
            return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
        return rng.randrange(*args) if kind == "int" else rng.choice(args)
    ranges = SEARCH_SPACE.get(model, {}) if space is None else space
    return [{name: one(*spec) for name, spec in ranges.items()} for _ in range(n)]


def random_search(df: DataFrame, features: Sequence[str], target: str, model: str, n: int = 10,
                  k: int = 3, threads: int = 4, seed: int = 42, space: Mapping[str, tuple] | None = None,
                  matrix: Binned | None = None) -> tuple[dict[str, Any], DataFrame]:
    """Best of ``n`` draws by mean R2 over time folds, and the table of all draws."""
    draws = draw_params(model, n, seed, space)
    named = {f"{d:02d}": (model, params) for d, params in enumerate(draws if draws[0] else [{}])}
    summary = cv_summary(cross_validate(df, features, target, named, k, threads, seed, matrix))
    scored = summary.collect()  # one row per draw
    best = max(sorted(scored, key=lambda r: r["model"]), key=lambda r: r["R2"])
    return draws[int(best["model"])], df.sparkSession.createDataFrame(scored, summary.schema)


def encode_categories(columns: Sequence[str]) -> Pipeline:
    """Indexed one-hot vectors ``{column}_hot``; unseen and null values get their own slot."""
    index = StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns],
                        dropLast=False, handleInvalid="keep")
    return Pipeline(stages=[index, hot])
