"""Daily load series and its row-based time features.

Every operator takes ``keys`` (series keys, default none) and partitions its
windows by them, so many series run in parallel. A series has one row per
(keys, day), i.e. it is bounded by the number of days, never by the number of
sessions: the unkeyed window handles a few hundred rows per year of data.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import columns as C

TARGET = "total_kwh"
DATE = "stat_date"
# Fixed feature definitions (lags and windows in rows, not calendar days).
LAGS = (1, 2, 3, 7, 14)
ANCHOR_WINDOW = 14
SHORT_WINDOW = 7
TRAIN_FRACTION = 0.8
# Walk-forward defaults: first training length, step, test horizon, shortest test.
WF_START, WF_STEP, WF_HORIZON, WF_MIN_TEST = 110, 21, 21, 5


def daily_series(sessions: DataFrame, keys: Sequence[str] = (), ts: str = "started") -> DataFrame:
    """One row per (keys, day) with sessions, kWh, fee and active stations.
    Partial aggregation runs before the shuffle; the distinct count is planned
    as a (day, station) pre-aggregation by Spark."""
    return (sessions.groupBy(*keys, F.to_date(ts).alias(DATE))
            .agg(F.count(F.lit(1)).alias("sessions"), F.sum("energy").alias("total_kwh"),
                 F.sum("fees").alias("total_fee"), F.count_distinct("station").alias("active_stations")))


def load_series(daily: DataFrame, keys: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """Numeric coercion (NULL on failure); with ``ordered``, by keys and date for presentation."""
    loaded = daily.select(*[c for c in daily.columns if c not in ("total_kwh", "sessions")],
                        C.safe_double(F.col("total_kwh").cast("string")).alias("total_kwh"),
                        C.safe_long(F.col("sessions").cast("string")).alias("sessions"))
    return loaded.orderBy(*keys, DATE) if ordered else loaded


def _order(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(DATE)


def add_index(df: DataFrame, keys: Sequence[str] = (), name: str = "t") -> DataFrame:
    """0-based row position by date (not days elapsed)."""
    return df.withColumn(name, (F.row_number().over(_order(keys)) - 1).cast("int"))


def add_lags(df: DataFrame, keys: Sequence[str] = (), col: str = TARGET,
             lags: Sequence[int] = LAGS) -> DataFrame:
    """Value ``k`` rows earlier."""
    w = _order(keys)
    return df.select("*", *[F.lag(col, k).over(w).alias(f"lag{k}_kwh") for k in lags])


def rolling_mean(col: str, n: int, keys: Sequence[str] = ()) -> Column:
    """Mean of the previous ``n`` rows, current row excluded, NULL until full."""
    w = _order(keys).rowsBetween(-n, -1)
    return F.when(F.count(col).over(w) == n, F.avg(col).over(w))


def add_rolling(df: DataFrame, n: int, keys: Sequence[str] = (), col: str = TARGET,
                name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"roll{n}_kwh", rolling_mean(col, n, keys))


def add_position(df: DataFrame, keys: Sequence[str] = (), name: str = "pos") -> DataFrame:
    """Row position after filtering (what ``reset_index`` gives)."""
    return add_index(df, keys, name)


def time_split(df: DataFrame, keys: Sequence[str] = (), frac: float = TRAIN_FRACTION) -> DataFrame:
    """Chronological split; the first ``int(frac·n)`` rows are train."""
    w = _order(keys)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    pos = F.row_number().over(w) - 1
    return df.withColumn("split", F.when(pos < F.floor(n * F.lit(frac)), F.lit("train")).otherwise(F.lit("test")))


def folds(positions: DataFrame, keys: Sequence[str] = (), start: int = WF_START, step: int = WF_STEP,
          horizon: int = WF_HORIZON, min_test: int = WF_MIN_TEST, pos: str = "pos") -> DataFrame:
    """Expanding-window folds over row positions.

    Fold ``f`` trains on ``[0, i)`` and tests ``[i, i+horizon)`` with
    ``i = start + f·step`` while ``i + min_test <= n``. Returns
    ``keys, fold, train_end, test_end`` from one aggregate per series.
    """
    n = positions.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    last = F.col("_n") - min_test
    f = n.filter(last >= start).select(*keys, "_n", F.explode(F.sequence(F.lit(start), last, F.lit(step))).alias("i"))
    return f.select(*keys, ((F.col("i") - start) / step).cast("int").alias("fold"),
                    F.col("i").cast("int").alias("train_end"),
                    F.least(F.col("i") + horizon, F.col("_n")).cast("int").alias("test_end"))


def test_rows_by_fold(rows: DataFrame, fold_table: DataFrame, keys: Sequence[str] = (),
                      start: int = WF_START, step: int = WF_STEP, horizon: int = WF_HORIZON,
                      pos: str = "pos") -> DataFrame:
    """Rows of every fold's test window: each row lists the folds whose window
    covers it (at most ceil(horizon/step) of them) and is exploded, so the
    join to the fold table is an equi-join on (keys, fold)."""
    p = F.col(pos)
    lo = F.greatest(F.lit(0), F.ceil((p - start - horizon + 1) / F.lit(step)))
    hi = F.floor((p - start) / F.lit(step))
    cand = rows.filter(p >= start).withColumn("fold", F.explode(F.sequence(lo.cast("int"), hi.cast("int"))))
    # one series: the fold table has ceil(days / step) rows, so it is broadcast;
    # many series: a shuffle join on (keys, fold)
    j = cand.join(F.broadcast(fold_table) if not keys else fold_table, [*keys, "fold"])
    return j.filter((p >= F.col("train_end")) & (p < F.col("test_end")))


def tail_rows(df: DataFrame, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Last ``n`` rows per series (distributed top-n, no global sort)."""
    if not keys:
        return df.orderBy(F.col(DATE).desc()).limit(n)
    w = Window.partitionBy(*keys).orderBy(F.col(DATE).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def split_summary(df: DataFrame, keys: Sequence[str] = (), col: str = TARGET) -> DataFrame:
    """Rows, first/last date and target mean per split."""
    return df.groupBy(*keys, "split").agg(F.count(F.lit(1)).alias("rows"), F.min(DATE).alias("first_date"),
                                          F.max(DATE).alias("last_date"), F.avg(col).alias("mean_target"))


def audit(daily: DataFrame) -> DataFrame:
    """``metric, value`` text rows (kWh total to one decimal, plain notation)."""
    a = daily.agg(F.count(F.lit(1)).alias("rows"), F.min(DATE).alias("mn"), F.max(DATE).alias("mx"),
                  F.sum("sessions").alias("s"), C.round_half_up(F.sum("total_kwh"), 1).alias("k"))

    def row(metric, value):
        return F.struct(F.lit(metric).alias("metric"), value.cast("string").alias("value"))
    return a.select(F.explode(F.array(
        row("daily rows", F.col("rows")), row("min date", F.col("mn")), row("max date", F.col("mx")),
        row("sessions_total", F.col("s")), row("kwh_total", F.col("k").cast("decimal(38,1)")),
    )).alias("r")).select("r.*")
