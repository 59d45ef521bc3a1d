"""Time-ordered folds and the scores computed over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tremora.operators.rows import best_rows
from tremora.session import materialise

SCORES = ("MSE", "RMSE", "MAE", "R2", "Explained Variance")


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> tuple[DataFrame, int]:
    """Number all rows from 0 in a total order, and their count.

    A range-partitioned sort numbers rows inside each partition; the partition sizes,
    one row each, give the offsets. The order columns must identify a row, both for
    a stable result and so that the sort can split equal times.
    """
    ordered = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ordered = materialise(
        ordered.withColumn("_part", F.shiftright("_mid", 33))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mid"),
        "ordered",
    )
    sizes = ordered.groupBy("_part").count().orderBy("_part").collect()  # one row per partition
    offsets, total = [], 0
    for part, count in sizes:
        offsets.append((part, total))
        total += count
    if not offsets:
        return ordered.withColumn(name, F.lit(0).cast("long")).drop("_part", "_pos"), 0
    table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    indexed = ordered.join(F.broadcast(table), "_part").withColumn(name, F.col("_offset") + F.col("_pos"))
    return indexed.select(*df.columns, name), total


def time_folds(df: DataFrame, order: Sequence[str], k: int = 3) -> DataFrame:
    """Add ``row_index`` and ``test_fold``.

    With t = n // (k + 1), fold i (0-based) tests the i-th of the last k runs of t
    rows and trains on every earlier row; rows before the first run have a null fold.
    """
    indexed, n = with_row_index(df, order)
    if n < k + 1:
        raise ValueError(f"{k} folds need more than {k} rows, got {n}")
    size = n // (k + 1)
    start = n - k * size
    fold = F.floor((F.col("row_index") - start) / size).cast("int")
    return indexed.withColumn("test_fold", F.when(F.col("row_index") >= start, fold))


def training_rows(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("test_fold").isNull() | (F.col("test_fold") < fold))


def test_rows(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("test_fold") == fold)


def baseline_mean(df: DataFrame, target: str, k: int = 3) -> DataFrame:
    """Mean of the target over each fold's training rows, from one pass."""
    sums = df.groupBy("test_fold").agg(F.sum(target).alias("s"), F.count(target).alias("c"))
    # k + 1 rows are left: each fold adds up the rows before its own
    earlier = Window.orderBy(F.col("test_fold").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    means = sums.select(
        F.col("test_fold").alias("fold"), F.try_divide(F.sum("s").over(earlier), F.sum("c").over(earlier)).alias("prediction")
    )
    return means.where(F.col("fold").between(0, k - 1))


def fold_metrics(df: DataFrame, by: Sequence[str] = ("target", "model", "fold"),
                 truth: str = "y", predicted: str = "prediction") -> DataFrame:
    """MSE, MAE, R2 and explained variance; a constant truth scores 1 if matched and 0 if not."""
    error = F.col(truth) - F.col(predicted)
    sums = df.groupBy(*by).agg(
        F.avg(error * error).alias("MSE"),
        F.avg(F.abs(error)).alias("MAE"),
        F.var_pop(error).alias("_ve"),
        F.var_pop(truth).alias("_vy"),
        F.min(truth).alias("_lo"),
        F.max(truth).alias("_hi"),
    )
    constant = F.col("_lo") == F.col("_hi")

    def score(loss: str):
        return F.when(constant, F.when(F.col(loss) == 0, 1.0).otherwise(0.0)).otherwise(
            1.0 - F.try_divide(F.col(loss), F.col("_vy"))
        )

    return sums.select(*by, "MSE", "MAE", score("MSE").alias("R2"), score("_ve").alias("Explained Variance"))


def cv_summary(metrics: DataFrame, by: Sequence[str] = ("target", "model")) -> DataFrame:
    """Means over folds; RMSE is the mean of the folds' own roots."""
    return metrics.groupBy(*by).agg(
        F.avg("MSE").alias("MSE"),
        F.avg(F.sqrt("MSE")).alias("RMSE"),
        *[F.avg(F.col(f"`{c}`")).alias(c) for c in ("MAE", "R2", "Explained Variance")],
    )


def select_best(summary: DataFrame, model_order: Sequence[str], by: Sequence[str] = ("target",)) -> DataFrame:
    """Best mean R2 per target; on a tie the model listed first wins."""
    position = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model"))
    return best_rows(summary, by, [F.col("R2").desc_nulls_last(), position])
