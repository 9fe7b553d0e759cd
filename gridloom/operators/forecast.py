"""Error metrics, baselines and the recursive multi-day forecast
(A17-A20, M2, M9, W6-W9, M12).

The recursion runs without a Python loop: the model's features do not contain
the anchor, so the ratios of all future days are known up front; only the
anchor (mean of the last 14 values, actual then predicted) is recursive. It is
folded with ``aggregate`` over an array per series: one row per series, so
series are forecast in parallel and no series passes through the driver.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators import quality as Q
from gridloom.operators import series as SR
from gridloom.operators.calendar import with_calendar
from gridloom.operators.joins import join_series

MAX_HORIZON = 366
HISTORY_POINTS = 14


def check_horizon(days: int) -> int:
    """1..366 days."""
    if not 1 <= int(days) <= MAX_HORIZON:
        raise ValueError(f"forecast horizon must be within 1..{MAX_HORIZON} days")
    return int(days)


# ------------------------------------------------------------------ metrics
def metrics(df: DataFrame, y: str = SR.TARGET, p: str = "pred", by: Sequence[str] = ("model",)) -> DataFrame:
    """MAE, RMSE and sMAPE (0..200 %) per group."""
    return df.groupBy(*by).agg(
        F.avg(C.abs_error(y, p)).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2))).alias("rmse"),
        (F.avg(C.smape_term(y, p)) * 100).alias("smape"))


def fold_summary(fold_mae: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean, population std and count of the per-fold MAE."""
    return fold_mae.groupBy(*by).agg(F.avg("mae").alias("wf_mae"), F.stddev_pop("mae").alias("wf_std"),
                                     F.count(F.lit(1)).alias("folds"))


def select_best(summary: DataFrame, score: str = "wf_mae", name: str = "model") -> DataFrame:
    """The candidate with the lowest score (one row)."""
    return summary.agg(F.min_by(name, score).alias(name), F.min(score).alias(score))


# ------------------------------------------------------------------ baselines (M2, M9)
NAIVE = {"naive_lag7": "lag7_kwh", "naive_anchor14": "roll14_kwh"}


def naive_predictions(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long table ``keys, model, stat_date, pos, total_kwh, pred`` of the
    parameter-free baselines (previous-week value, 14-row mean)."""
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("pred")) for m, c in NAIVE.items()])
    cols = [*keys, SR.DATE, SR.TARGET] + [c for c in ("pos", "split") if c in features.columns]
    return features.select(*cols, F.explode(arr).alias("_m")).select(*cols, "_m.model", "_m.pred")


def walk_forward_errors(preds: DataFrame, fold_table: DataFrame, keys: Sequence[str] = (),
                        by: Sequence[str] = ("model",), **fold_args) -> DataFrame:
    """Per-fold MAE of predictions that need no training (or were produced per fold)."""
    rows = SR.test_rows_by_fold(preds, fold_table, keys, **fold_args)
    return rows.groupBy(*keys, *by, "fold").agg(F.avg(C.abs_error(SR.TARGET, "pred")).alias("mae"))


# ------------------------------------------------------------------ sessions from kWh
def session_model(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Least squares sessions ~ kWh per series: ``keys, slope, intercept``."""
    return history.groupBy(*keys).agg(F.regr_slope("sessions", SR.TARGET).alias("slope"),
                                      F.regr_intercept("sessions", SR.TARGET).alias("intercept"))


def estimate_sessions(x: Column | str) -> Column:
    """Prediction floored at 0 (needs ``slope``/``intercept`` columns); NULL when it is NULL or NaN."""
    y = F.col("intercept") + F.col("slope") * C.col(x)
    return F.when(y.isNotNull() & ~F.isnan(y), F.greatest(y, F.lit(0.0)))


# ------------------------------------------------------------------ future frame
def future_frame(history: DataFrame, days: int, calendar: DataFrame, keys: Sequence[str] = (),
                 index_col: str | None = "t") -> DataFrame:
    """``keys, stat_date, t, dow, is_holiday, is_rest`` for the next ``days``
    dates after each series' last day; ``t`` continues from the largest index."""
    days = check_horizon(days)
    aggs = [F.max(SR.DATE).alias("_last")]
    if index_col:
        aggs.append(F.max(index_col).alias("_tmax"))
    last = history.groupBy(*keys).agg(*aggs)
    f = last.select(*keys, *(["_tmax"] if index_col else []), "_last",
                    F.posexplode(F.sequence(F.date_add("_last", 1), F.date_add("_last", days))).alias("_i", SR.DATE))
    cols = [*keys, SR.DATE]
    if index_col:
        cols.append((F.col("_tmax") + F.col("_i") + 1).cast("int").alias(index_col))
    f = f.select(*cols, C.dow0(SR.DATE).alias("dow"))
    return with_calendar(f, calendar).drop("is_makeup")


# ------------------------------------------------------------------ recursion
def recursive_forecast(history: DataFrame, ratios: DataFrame, keys: Sequence[str] = (),
                       window: int = SR.ANCHOR_WINDOW, value: str = SR.TARGET) -> DataFrame:
    """Fold future ratios over the last ``window`` actual values per series.

    ``ratios``: ``keys, stat_date, ratio`` (plain ratio, e.g. ``exp`` of a log
    model output). For day ``i``: anchor = mean of the last ≤ ``window`` values
    (actual, then predicted); pred = anchor · clip(ratio, 0, 3).
    Returns ``keys, stat_date, anchor, ratio, pred``.
    """
    tail = SR.tail_rows(history.select(*keys, SR.DATE, value), window, keys)
    hist = tail.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(SR.DATE, value))), lambda x: x[value].cast("double"))
        .alias("_h"))
    rat = ratios.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(SR.DATE, "ratio"))).alias("_r"))
    if keys:
        j = join_series(hist, rat, keys)
    else:  # both sides are single rows
        j = hist.withColumn("_k", F.lit(1)).join(rat.withColumn("_k", F.lit(1)), "_k").drop("_k")

    def mean(a):
        return F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)

    def step(acc, x):
        anchor = mean(acc["hist"])
        pred = anchor * C.clip_ratio(x["ratio"])
        grown = F.concat(acc["hist"], F.array(pred))
        return F.struct(F.slice(grown, F.greatest(F.size(grown) - window + 1, F.lit(1)), window).alias("hist"),
                        F.concat(acc["anchors"], F.array(anchor)).alias("anchors"),
                        F.concat(acc["preds"], F.array(pred)).alias("preds"))

    init = F.struct(F.col("_h").alias("hist"), F.array().cast("array<double>").alias("anchors"),
                    F.array().cast("array<double>").alias("preds"))
    folded = j.select(*keys, "_r", F.aggregate("_r", init, step).alias("_s"))
    z = folded.select(*keys, F.inline(F.arrays_zip(
        F.col("_r")[SR.DATE].alias(SR.DATE), F.col("_r")["ratio"].alias("ratio"),
        F.col("_s.anchors").alias("anchor"), F.col("_s.preds").alias("pred"))))
    return z.select(*keys, SR.DATE, "anchor", "ratio", "pred")


def dow_ratio_profile(features: DataFrame, keys: Sequence[str] = (), anchor: str = "roll14_kwh") -> DataFrame:
    """Mean ratio actual / anchor per weekday (``keys, dow, ratio``): a
    deterministic, data-derived ratio table for the recursion."""
    f = features.filter(F.col(anchor).isNotNull())
    return f.groupBy(*keys, C.dow0(SR.DATE).alias("dow")).agg(
        F.avg(F.try_divide(F.col(SR.TARGET), F.col(anchor))).alias("ratio"))


# ------------------------------------------------------------------ presentation
def history_tail(history: DataFrame, n: int = HISTORY_POINTS, keys: Sequence[str] = ()) -> DataFrame:
    return SR.tail_rows(history, n, keys)


def forecast_report(forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S12/P20 rows: ``forecast_date, weekday, is_holiday, pred_kwh, pred_sessions``
    with the forecast rounded to one decimal."""
    return forecast.select(*keys, F.date_format(SR.DATE, "yyyy-MM-dd").alias("forecast_date"),
                           F.date_format(SR.DATE, "E").alias("weekday"), "is_holiday",
                           C.round_half_up("pred", 1).alias("pred_kwh"),
                           C.round_half_up("pred_sessions", 1).alias("pred_sessions"))


def bridge(history: DataFrame, forecast: DataFrame, metric: str = "energy",
           keys: Sequence[str] = ()) -> DataFrame:
    """Chart rows ``keys, date, role, value``: history, forecast, and the
    last actual point repeated as the first forecast point (bridge)."""
    h = history.select(*keys, F.col("date"), F.lit("history").alias("role"), F.col(metric).alias("value"))
    f = forecast.select(*keys, F.col("date"), F.lit("forecast").alias("role"), F.col(metric).alias("value"))
    last = SR.tail_rows(history.withColumnRenamed("date", SR.DATE), 1, keys).withColumnRenamed(SR.DATE, "date")
    b = last.select(*keys, F.col("date"), F.lit("forecast").alias("role"), F.col(metric).alias("value"))
    return h.unionByName(f).unionByName(b)


def forecast_payload(history_points: DataFrame, forecast_points: DataFrame, generated_at: Column,
                     keys: Sequence[str] = ()) -> DataFrame:
    """One JSON document per series: ``generated_at, history_end,
    history[], forecast[]`` (points ``date, energy, sessions``), sorted by date."""
    def points(sessions: str) -> Column:
        return F.sort_array(F.collect_list(F.struct(F.col("date"), F.col("energy").cast("double").alias("energy"),
                                                    F.col("sessions").cast(sessions).alias("sessions"))))
    # actual sessions are counts, forecast ones estimates
    h = history_points.groupBy(*keys).agg(points("bigint").alias("history"), F.max("date").alias("history_end"))
    f = forecast_points.groupBy(*keys).agg(points("double").alias("forecast"))
    if keys:
        j = h.join(f, list(keys))
    else:
        j = h.withColumn("_k", F.lit(1)).join(f.withColumn("_k", F.lit(1)), "_k").drop("_k")
    doc = F.struct(generated_at.alias("generated_at"), F.col("history_end"), F.col("history"), F.col("forecast"))
    return j.select(*keys, doc.alias("doc"), F.to_json(doc, {"ignoreNullFields": "false"}).alias("payload"))


def payload_check(payload: DataFrame) -> DataFrame:
    """F8/F9 for the forecast document: all four fields non-empty, all values finite."""
    d = F.col("doc")

    def finite(points):
        return F.forall(points, lambda p: ~C.is_nonfinite(p["energy"].cast("double"))
                        & ~C.is_nonfinite(p["sessions"].cast("double")))
    ok = (d["generated_at"].isNotNull() & d["history_end"].isNotNull() & (F.size(d["history"]) > 0)
          & (F.size(d["forecast"]) > 0) & finite(d["history"]) & finite(d["forecast"]))
    ok = ok & Q.all_finite(d, payload.schema["doc"].dataType)
    # an unknown verdict is a refusal
    return payload.agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("ok")).select(
        "ok", F.when(F.col("ok"), F.lit(None)).otherwise(F.lit("incomplete or non-finite forecast")).alias("reason"))
