"""Dashboard marts built from rollups.

All inputs here are rollup outputs, i.e. bounded by the key cardinality of a
dimension, never by the number of sessions.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import round_half_up

METRICS = ("energy", "sessions")
# Presentation precision: measures 2 decimals, counts integral.
DISPLAY_DECIMALS = 2
COUNT_COLUMNS = ("sessions", "samples", "stations")


def _metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    return metric


def top_n(rollup: DataFrame, key: str, metric: str = "energy", n: int = 10) -> DataFrame:
    """O3: highest ``metric`` first, ties by key. Spark plans a per-partition
    top-n and a merge (TakeOrderedAndProject), not a full sort."""
    m = _metric(metric)
    top = rollup.orderBy(F.col(m).desc(), F.col(key).asc()).limit(n)
    return top.select(F.row_number().over(Window.orderBy(F.col(m).desc(), F.col(key).asc())).alias("rank"),
                      key, m)


def share(rollup: DataFrame, key: str, metric: str = "energy") -> DataFrame:
    """Value and share of the total. The total is a one-row aggregate
    broadcast to every partition (no single-partition window)."""
    m = _metric(metric)
    total = rollup.agg(F.sum(m).alias("_total")).withColumn("_k", F.lit(1))
    return (rollup.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")
            .select(key, F.col(m).alias("value"), (F.col(m) / F.col("_total")).alias("share")))


def pivot_matrix(rollup: DataFrame, row: str = "platform", column: str = "facility",
                 metric: str = "energy", values: Sequence[str] | None = None) -> DataFrame:
    """V1: rows × sorted columns, zero for missing combinations.

    Without ``values`` Spark first runs ``rollup`` for its distinct columns, so pass a written table.
    """
    m = _metric(metric)
    g = rollup.groupBy(row)
    p = g.pivot(column, sorted(values) if values else None).agg(F.sum(m))
    return p.fillna(0)


def dense_grid(spark: SparkSession, rollup: DataFrame, metric_cols: Sequence[str] = ("sessions", "energy"),
               days: int = 7, hours: int = 24) -> DataFrame:
    """The full weekday × hour grid, zero where no session happened. The
    grid comes from ``range`` (no cross join); the join is on both keys."""
    grid = spark.range(days * hours).select(
        (F.col("id") / hours).cast("int").alias("_d"), (F.col("id") % hours).cast("int").alias("hour"))
    grid = grid.select((F.col("_d") + 1).alias("weekday"), "hour")
    r = rollup.select("weekday", "hour", *metric_cols)
    out = grid.join(F.broadcast(r), ["weekday", "hour"], "left")  # r: at most days × hours rows
    return out.select("weekday", "hour", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in metric_cols])


def category_series(long: DataFrame, metric: str = "energy") -> DataFrame:
    """V2: ``chart, category, value`` of the category charts, one per dimension
    of a long rollup: a projection, so the one aggregate below serves them all."""
    return long.select(F.col("dimension").alias("chart"), F.col("key1").alias("category"),
                       F.col(_metric(metric)).cast("double").alias("value"))


def battery_points(bands: DataFrame) -> DataFrame:
    """V3: scatter points ``soc_band, temperature, samples``."""
    return bands.select("soc_band", "temperature", "samples")


def display(df: DataFrame, decimals: int = DISPLAY_DECIMALS) -> DataFrame:
    """Round measures (half-up) as the last projection; counts integral."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in COUNT_COLUMNS:
            out.append(F.round(c, 0).cast("bigint").alias(f.name))
        elif f.dataType.typeName() in ("double", "float"):
            out.append(round_half_up(c, decimals).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
