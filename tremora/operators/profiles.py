"""Distributions: table profile, histograms, box statistics, correlations, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tremora.operators.gram import pair_sums
from tremora.operators.quantiles import IN_MEMORY_ROWS, quantiles, selected_quantiles, sketched_quantiles, value_sketches
from tremora.operators.reshape import to_long
from tremora.session import broadcast_if_small

QUARTILES = (0.25, 0.5, 0.75)


def profile(df: DataFrame, numeric: Sequence[str], in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """One row per column: type, rows, nulls and, for numeric ones, describe statistics."""
    def one(c: str, dtype: str) -> Column:
        x = F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.lit(dtype).alias("dtype"),
            F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(f"`{c}`").isNull()).alias("n_null"),
            F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        )
    stats = df.agg(F.array(*[one(c, t) for c, t in df.dtypes]).alias("s")).select(F.inline("s"))
    q = quantiles(df, numeric, QUARTILES, in_memory_rows=in_memory_rows).select(
        F.col("feature").alias("column"), *[F.get("q", F.lit(i)).alias(f"q{p}") for i, p in enumerate((25, 50, 75))]
    )
    return stats.join(F.broadcast(q), "column", "left").withColumn("n_columns", F.lit(len(df.columns)))


def sketched_profile(df: DataFrame, numeric: Sequence[str], keys: Sequence[str] = (), k: int = 400) -> DataFrame:
    """Quartiles of each column and key, off by at most ``quantiles.rank_error(k)`` of the values in rank, from one pass."""
    q = sketched_quantiles(value_sketches(df, numeric, keys, k), QUARTILES)
    return q.select(*keys, "feature", "n", *[F.get("q", F.lit(i)).alias(f"q{round(100 * p)}") for i, p in enumerate(QUARTILES)])


def histogram(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), bins: int = 30) -> DataFrame:
    """Equal-width counts over each group's own range, last bin closed, empty bins kept.

    A range of one value is widened by a half on both sides.
    """
    by = [*keys, "feature"]
    long = to_long(df, columns, keys, "feature", "value").where("value is not null")
    ranges = long.groupBy(*by).agg(F.min("value").alias("a"), F.max("value").alias("b")).select(
        *by,
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )
    ranges = broadcast_if_small(ranges)
    width = F.col("hi") - F.col("lo")
    slot = F.least(F.floor((F.col("value") - F.col("lo")) * bins / width).cast("int") + 1, F.lit(bins))
    counted = long.join(ranges, by).groupBy(*by, slot.alias("bin")).agg(F.count("*").alias("n"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return grid.join(counted, [*by, "bin"], "left").select(
        *by, "bin",
        (F.col("lo") + width * (F.col("bin") - 1) / bins).alias("bin_start"),
        (F.col("lo") + width * F.col("bin") / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
              in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """Quartiles, whiskers (furthest data within 1.5 IQR) and the number of outliers."""
    by = [*keys, "feature"]
    q = quantiles(df, columns, QUARTILES, keys, in_memory_rows).select(
        *by, "n", *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    q = broadcast_if_small(q)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    long = to_long(df, columns, keys, "feature", "value").where("value is not null")
    return (
        long.join(q, by)
        .groupBy(*by, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("lo"),
            F.max(F.when(inside, F.col("value"))).alias("hi"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .select(*by, "n", "q1", "median", "q3",
                F.least("lo", "q1").alias("whisker_low"), F.greatest("hi", "q3").alias("whisker_high"), "n_outliers")
    )


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], first: str, second: str) -> DataFrame:
    """Pearson over the rows where both columns are present; null when either is constant there.

    One pass gives the columns' means, a second the sums of all pairs.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    means = df.agg(*[F.avg(F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))) for c in columns]).first()
    place = {c: i for i, c in enumerate(columns)}
    sums = pair_sums(df, columns, [(place[x], place[y]) for x, y in pairs], [m or 0.0 for m in means])

    def spread(total: str, squares: str) -> Column:
        # what is left of equal values after subtracting is rounding
        left = F.col(squares) - F.try_divide(F.col(total) * F.col(total), F.col("n"))
        return F.when(left > 1e-12 * F.col(squares), left)

    together = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n"))
    corr = F.when(F.col("n") > 1, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), together / F.sqrt(spread("sa", "saa") * spread("sb", "sbb")))))
    names = F.array(*[F.struct(F.lit(x).alias(first), F.lit(y).alias(second)) for x, y in pairs])
    scored = sums.select("i", F.when(spread("sa", "saa").isNotNull() & spread("sb", "sbb").isNotNull(), corr).alias("corr"))
    return scored.select(F.get(names, F.col("i").cast("int")).alias("p"), "corr").select("p.*", "corr")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full Pearson matrix in long form, from one pass over the table."""
    half = [(x, y) for i, x in enumerate(columns) for y in columns[i:]]
    upper = _correlations(df, half, "x", "y")
    mirrored = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(
        F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    )
    return upper.select(F.explode(mirrored).alias("p"), "corr").select("p.x", "p.y", "corr")


def corr_cross(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """The feature-by-target block of the matrix."""
    missing = [c for c in (*features, *targets) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return _correlations(df, [(f, t) for f in features for t in targets], "feature", "target")


def iqr_filter(df: DataFrame, features: Sequence[str], in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """Drop rows outside 1.5 IQR, feature after feature.

    Each feature's quartiles come from the rows the earlier ones left, so there is
    one round of passes per feature; two numbers per feature reach the driver and go back as
    literals the scan can push down. Columns of over ``in_memory_rows`` values are
    selected from by histograms. Nulls fail the comparison.
    """
    for c in features:
        n = df.agg(F.count(f"`{c}`")).first()[0]
        if not n:
            return df.where("false")
        if n <= in_memory_rows:
            q1, q3 = df.agg(F.percentile(F.col(f"`{c}`").cast("double"), F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
        else:
            q1, q3 = selected_quantiles(df, [c], (0.25, 0.75)).first()["q"]
        reach = 1.5 * (q3 - q1)
        df = df.where(F.col(f"`{c}`").between(q1 - reach, q3 + reach))
    return df


def radar_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of each listed column the table has, one row per column; nothing from no rows."""
    have = [c for c in columns if c in df.columns]
    if not have:
        return df.sparkSession.createDataFrame([], "rating string, mean double")
    means = df.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in have]).where("_n > 0")
    return means.unpivot([], have, "rating", "mean")
