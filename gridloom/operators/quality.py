"""Reconciliation and quality counters."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import columns as C
from gridloom.operators.rollups import DIMENSIONS

# Fixed policy texts carried with the quality counters.
YEAR_POLICY = "0014/0015 interpreted as 2014/2015; station metadata is a later snapshot"
TELEMETRY_TIME = "Unavailable: source scientific notation lost precision"
MIN_DIMENSIONS = len(DIMENSIONS)


class ReconciliationError(RuntimeError):
    pass


def all_finite(value: Column, kind: T.DataType) -> Column:
    """whether no number at any depth of a value is NaN or infinite; a null holds none."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return ~F.coalesce(C.is_nonfinite(value), F.lit(False))
    if isinstance(kind, T.StructType):
        sound = F.lit(True)
        for field in kind.fields:
            if _holds_floats(field.dataType):
                sound = sound & all_finite(value[field.name], field.dataType)
        return sound
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.forall(value, lambda x: all_finite(x, kind.elementType)), F.lit(True))
    if isinstance(kind, T.MapType):
        return (all_finite(F.map_keys(value), T.ArrayType(kind.keyType))
                & all_finite(F.map_values(value), T.ArrayType(kind.valueType)))
    return F.lit(True)


def _holds_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_floats(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_floats(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_floats(kind.keyType) or _holds_floats(kind.valueType)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def dimension_totals(long: DataFrame) -> DataFrame:
    return long.groupBy("dimension").agg(F.sum("sessions").alias("sessions"))


def reconcile(long: DataFrame, total: DataFrame) -> DataFrame:
    """dimensions whose session sum differs from the total (empty = ok).

    ``total`` is a one-row frame with column ``total``; the join key is a
    literal on both sides, so the one-row side is broadcast.
    """
    t = total.select(F.col("total"), F.lit(1).alias("_k"))
    return (dimension_totals(long).withColumn("_k", F.lit(1))
            .join(F.broadcast(t), "_k").drop("_k")
            .filter(F.col("sessions") != F.col("total")))


def require_reconciled(long: DataFrame, total: DataFrame) -> None:
    bad = reconcile(long, total).limit(1).collect()
    if bad:
        raise ReconciliationError(f"sessions of {bad[0]['dimension']} do not add up to the total")


def reconcile_daily(daily: DataFrame, sessions: DataFrame) -> DataFrame:
    """one row comparing Σ daily sessions with the session count."""
    a = daily.agg(F.sum("sessions").alias("daily_sessions"))
    b = sessions.agg(F.count(F.lit(1)).alias("total_sessions"))
    return (a.withColumn("_k", F.lit(1)).join(F.broadcast(b.withColumn("_k", F.lit(1))), "_k").drop("_k")
            .withColumn("reconciled", F.col("daily_sessions") == F.col("total_sessions")))


def nonfinite_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """long table ``column, nonfinite`` from one aggregate pass."""
    agg = df.agg(*[F.count_if(C.is_nonfinite(c)).alias(c) for c in cols])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nonfinite")) for c in cols
    ])).alias("r")).select("r.*")


def snapshot_check(long: DataFrame, total: DataFrame,
                   min_dimensions: int = MIN_DIMENSIONS) -> DataFrame:
    """F8: ``total, dimensions, unreconciled, ok, reason`` in one row."""
    per_dim = dimension_totals(long)
    t = total.select("total", F.lit(1).alias("_k"))
    j = per_dim.withColumn("_k", F.lit(1)).join(F.broadcast(t), "_k")
    res = j.agg(F.max("total").alias("total"), F.count(F.lit(1)).alias("dimensions"),
                F.count_if(F.col("sessions") != F.col("total")).alias("unreconciled"))
    ok = (F.col("total") > 0) & (F.col("dimensions") >= min_dimensions) & (F.col("unreconciled") == 0)
    return res.select("*", ok.alias("ok"),
                      F.when(F.col("total") <= 0, F.lit("empty"))
                       .when(F.col("dimensions") < min_dimensions, F.lit("missing dimensions"))
                       .when(F.col("unreconciled") > 0, F.lit("reconciliation failed"))
                       .otherwise(F.lit(None).cast("string")).alias("reason"))


def quality_counters(classified: DataFrame, accepted_sessions: DataFrame,
                     sources: Mapping[str, DataFrame], battery_accepted: DataFrame | None = None,
                     battery_classified: DataFrame | None = None) -> DataFrame:
    """F10 as a long table ``metric, value``; duplicates = source − accepted − rejected.

    Classification keeps one row per source row, so the session source count
    and the rejected count come from one aggregate over ``classified``. With
    ``battery_classified`` (typed telemetry with ``is_valid``) the battery
    source and accepted counts are one aggregate too; otherwise they are
    counted from ``sources['battery']`` and ``battery_accepted``. Every other
    source is counted from ``sources``.
    """
    # One single-row aggregate per table, each computed once; the rows are
    # combined on a constant key (1 x 1 rows) and unpivoted into the long table.
    # (A union of per-metric branches would re-scan a table per metric: Spark
    # prunes each branch differently, so their exchanges cannot be reused.)
    one = [classified.agg(F.count(F.lit(1)).alias("source_sessions"),
                          F.count_if(~F.col("is_valid")).alias("rejected_sessions")),
           accepted_sessions.agg(F.count(F.lit(1)).alias("accepted_sessions"))]
    if battery_classified is not None:
        one.append(battery_classified.agg(F.count(F.lit(1)).alias("source_battery"),
                                          F.count_if("is_valid").alias("battery_accepted")))
    else:
        one += [sources["battery"].agg(F.count(F.lit(1)).alias("source_battery")),
                battery_accepted.agg(F.count(F.lit(1)).alias("battery_accepted"))]
    others = [n for n in sources if n not in ("sessions", "battery")]
    one += [sources[n].agg(F.count(F.lit(1)).alias(f"source_{n}")) for n in others]
    row = one[0].withColumn("_k", F.lit(1))
    for part in one[1:]:
        row = row.join(F.broadcast(part.withColumn("_k", F.lit(1))), "_k")
    metrics = [("rejected_sessions", F.col("rejected_sessions")),
               ("accepted_sessions", F.col("accepted_sessions")),
               ("battery_accepted", F.col("battery_accepted")),
               ("source_rows.sessions", F.col("source_sessions")),
               ("source_rows.battery", F.col("source_battery")),
               *[(f"source_rows.{n}", F.col(f"source_{n}")) for n in others],
               ("duplicates_removed",
                F.col("source_sessions") - F.col("accepted_sessions") - F.col("rejected_sessions"))]
    return row.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("bigint").alias("value"))
                                          for m, v in metrics])).alias("r")).select("r.*")
