"""Ridge regression of many series by two aggregates (M3).

The first gives each series its means, the second the sums of products of its
centred features and label: rows of fixed width per series, combined before the
shuffle whatever the number of its rows. The normal equations are then solved inside that row by elimination
with higher-order functions, so no series passes through the driver or a
Python worker, and rows meet their coefficients by a join on the series keys.

Defined results: rows with a null in the label or a feature do not train; a
series without training rows has no coefficients, and its predictions are null;
a null feature gives a null prediction.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.joins import join_series

ALPHA = 1.0


def solve(system: Column, size: int) -> Column:
    """The solution of the ``size`` equations of an augmented, positive definite matrix (array of rows)."""
    def eliminate(rows: Column, k: Column) -> Column:
        pivot = rows[k]
        return F.transform(rows, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / pivot[k])).otherwise(
            F.zip_with(row, pivot, lambda v, p: v - row[k] / pivot[k] * p)))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), system, eliminate)
    return F.transform(done, lambda row: row[size])


def coefficients(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = (),
                 alpha: float = ALPHA) -> DataFrame:
    """``keys..., rows, intercept, slopes`` (in order of ``features``); the penalty is on the slopes alone."""
    used = train.select(*keys, *[F.col(c).cast("double").alias(c) for c in (*features, label)]).dropna(
        subset=[*features, label])
    n = len(features)
    # Products are taken about each series' first moments, so that large values lose no digits in their differences.
    means = used.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg(label).alias("_my"),
                                    *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(features)])
    if keys:
        both = join_series(used, means, keys)
    else:  # one row of means
        both = used.withColumn("_k", F.lit(1)).join(F.broadcast(means.withColumn("_k", F.lit(1))), "_k")
    x = [F.col(c) - F.col(f"_m{i}") for i, c in enumerate(features)]
    y = F.col(label) - F.col("_my")
    sums = both.groupBy(*keys).agg(
        F.first("_n").alias("_n"), F.first("_my").alias("_my"), *[F.first(f"_m{i}").alias(f"_m{i}") for i in range(n)],
        *[F.sum(x[i] * x[j]).alias(f"_g{i}_{j}") for i in range(n) for j in range(i, n)],
        *[F.sum(x[i] * y).alias(f"_r{i}") for i in range(n)])

    def entry(i: int, j: int) -> Column:
        g = F.col(f"_g{min(i, j)}_{max(i, j)}")
        return g + F.lit(float(alpha)) if i == j else g

    system = F.array(*[F.array(*[entry(i, j) for j in range(n)], F.col(f"_r{i}")) for i in range(n)])
    solved = sums.select(*keys, F.col("_n").alias("rows"), "_my", F.array(*[F.col(f"_m{i}") for i in range(n)]).alias("_m"),
                         solve(system, n).alias("slopes"))
    return solved.filter(F.col("rows") > 0).select(*keys, "rows", (F.col("_my") - dot("_m", "slopes")).alias("intercept"),
                                                   "slopes")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def predict(rows: DataFrame, fitted: DataFrame, features: Sequence[str], keys: Sequence[str] = (),
            name: str = "pred") -> DataFrame:
    """All rows with a prediction from the coefficients of their series."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    if keys:
        both = join_series(rows, fitted.drop("rows"), keys, "left")
    else:  # one row of coefficients, or none
        both = (rows.withColumn("_k", F.lit(1))
                .join(F.broadcast(fitted.drop("rows").withColumn("_k", F.lit(1))), "_k", "left").drop("_k"))
    return both.withColumn(name, F.col("intercept") + dot(x, "slopes")).drop("intercept", "slopes")
