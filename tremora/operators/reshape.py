"""Long-to-wide and wide-to-long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pivot_mean(df: DataFrame, keys: Sequence[str], names: str, values: str, known: Sequence[str] | None = None,
               most: int = 1000) -> DataFrame:
    """One row per key, one column per name, duplicates averaged.

    Rows with a null key, name or value do not count, so a key without any value
    disappears. Conditional averages keep this to a single shuffle with map-side
    partial sums, whatever the number of rows behind one key.

    ``known`` names the columns and saves a pass; a name not among them fails the job
    rather than losing its rows. Without it the names are looked up first, in order; over
    ``most`` of them are refused.
    """
    complete = df.where(" and ".join(f"`{c}` is not null" for c in (*keys, names, values)))
    if known is None:
        known = [r[0] for r in complete.select(names).distinct().orderBy(names).limit(most + 1).collect()]
        if len(known) > most:
            raise ValueError(f"over {most} different values of {names}")
    listed = F.col(names).isin(list(known))
    name = F.when(listed, F.col(names)).otherwise(
        F.raise_error(F.concat(F.lit(f"{names} not listed: "), F.col(names).cast("string"))).cast(df.schema[names].dataType))
    means = [F.avg(F.when(F.col("_name") == k, F.col("_value"))).alias(k) for k in known]
    rows = complete.select(*keys, name.alias("_name"), F.col(values).alias("_value"))
    # one more aggregate over the checked name, so that the check is part of every plan
    return rows.groupBy(*keys).agg(F.count("_name").alias("_n"), *means).where("_n > 0").drop("_n")


def pivot_readings(df: DataFrame, measurements: Sequence[str] | None = None,
                   keys: Sequence[str] = ("device", "datetime", "location")) -> DataFrame:
    return pivot_mean(df, keys, "Measurement", "data", measurements)


def pivot_ratings(df: DataFrame, metrics: Sequence[str] | None = None,
                  keys: Sequence[str] = ("device", "datetime")) -> DataFrame:
    return pivot_mean(df, keys, "Metric", "Rating", metrics)


def to_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
            name: str = "Target", value: str = "Value") -> DataFrame:
    """Wide to long, skipping columns the table does not have."""
    have = [c for c in columns if c in df.columns]
    if not have:
        return df.select(*keys, F.lit("").alias(name), F.lit(None).cast("double").alias(value)).where("false")
    doubles = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in have])
    return doubles.unpivot(list(keys), have, name, value)


PAIR_ROWS = 5_000


def pair_points(df: DataFrame, features: Sequence[str], targets: Sequence[str],
                keys: Sequence[str] = (), rows: int | None = PAIR_ROWS) -> DataFrame:
    """Feature values beside target values of the same row, of at most ``rows`` rows (all with None).

    The rows are those whose keys have the smallest MD5, so they are the same however the table is
    split; each task hands on at most ``rows``. Without keys all columns that are asked for take their place,
    and rows alike in these may stand for each other.
    """
    missing = [c for c in (*features, *targets) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    if rows is not None:
        names = [F.col(f"`{c}`").cast("string") for c in (keys or [*features, *targets])]
        df = df.withColumn("_md5", F.md5(F.concat_ws("|", *names))).orderBy("_md5").limit(rows).drop("_md5")
    def pairs(cols: Sequence[str]):
        return F.array(*[F.struct(F.lit(c).alias("n"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])
    return (
        df.select(*keys, F.explode(pairs(features)).alias("f"), pairs(targets).alias("t"))
        .select(*keys, "f", F.explode("t").alias("t"))
        .select(*keys, F.col("f.n").alias("feature"), F.col("f.v").alias("x"),
                F.col("t.n").alias("target"), F.col("t.v").alias("y"))
    )
