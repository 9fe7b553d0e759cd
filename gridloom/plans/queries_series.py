"""Load-series queries: daily series, features, calendar, splits, folds,
baselines, metrics and the recursive forecast."""
from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators import calendar as CAL
from gridloom.operators import features as FE
from gridloom.operators import forecast as FC
from gridloom.operators import quality as Q
from gridloom.operators import series as SR
from gridloom.plans import oracle_sql as O
from gridloom.plans.catalog import register, stable
from gridloom.plans.inputs import Inputs
from gridloom.session import materialize, scratch_path
from gridloom.sources import raw as RAW
from gridloom.sources.fixtures import work_calendar

HORIZON = 7
PANEL_KEYS = ["priority"]

# ------------------------------------------------------------------ shared SQL
SERIES = """
orders_s AS (
  SELECT o_orderkey AS session_id, o_orderdate AS started, o_totalprice AS energy,
         o_totalprice * 0.02 AS fees, CAST(o_custkey AS VARCHAR) AS station, o_orderpriority AS priority
  FROM orders
),
daily AS (
  SELECT CAST(started AS DATE) AS stat_date, count(*) AS sessions, sum(energy) AS total_kwh,
         sum(fees) AS total_fee, count(DISTINCT station) AS active_stations
  FROM orders_s GROUP BY 1
),
cal_years AS (
  SELECT range AS year FROM range((SELECT min(year(stat_date)) FROM daily), (SELECT max(year(stat_date)) FROM daily) + 2)
),
calendar AS (
  SELECT make_date(year, h.m, h.d) AS cal_date, false AS is_workday, h.name AS holiday_name
  FROM cal_years, (VALUES (1, 1, 'New Year''s Day'), (5, 1, 'Labour Day'), (10, 1, 'National Day')) h(m, d, name)
  UNION ALL
  SELECT make_date(year, w.m, w.d), true, NULL
  FROM cal_years, (VALUES (5, 4), (10, 7)) w(m, d) WHERE isodow(make_date(year, w.m, w.d)) >= 6
),
base AS (
  SELECT d.*, CAST(row_number() OVER (ORDER BY stat_date) - 1 AS INTEGER) AS t,
         CAST(isodow(stat_date) - 1 AS INTEGER) AS dow
  FROM daily d
),
flagged AS (
  SELECT b.*,
    CAST(b.dow >= 5 AS INTEGER) AS is_weekend, CAST(month(b.stat_date) AS INTEGER) AS month,
    CAST(CASE WHEN c.cal_date IS NOT NULL THEN NOT c.is_workday ELSE b.dow >= 5 END AS INTEGER) AS is_rest,
    CAST(c.cal_date IS NOT NULL AND NOT c.is_workday AND c.holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
    CAST(c.cal_date IS NOT NULL AND c.is_workday AND b.dow >= 5 AS INTEGER) AS is_makeup
  FROM base b LEFT JOIN calendar c ON b.stat_date = c.cal_date
),
feat AS (
  SELECT *,
    CAST(dow = 0 AS INTEGER) AS dow_0, CAST(dow = 1 AS INTEGER) AS dow_1, CAST(dow = 2 AS INTEGER) AS dow_2,
    CAST(dow = 3 AS INTEGER) AS dow_3, CAST(dow = 4 AS INTEGER) AS dow_4, CAST(dow = 5 AS INTEGER) AS dow_5,
    CAST(dow = 6 AS INTEGER) AS dow_6,
    lag(total_kwh, 1) OVER w AS lag1_kwh, lag(total_kwh, 2) OVER w AS lag2_kwh,
    lag(total_kwh, 3) OVER w AS lag3_kwh, lag(total_kwh, 7) OVER w AS lag7_kwh,
    lag(total_kwh, 14) OVER w AS lag14_kwh,
    CASE WHEN count(total_kwh) OVER w7 = 7 THEN avg(total_kwh) OVER w7 END AS roll7_kwh,
    CASE WHEN count(total_kwh) OVER w14 = 14 THEN avg(total_kwh) OVER w14 END AS roll14_kwh
  FROM flagged
  WINDOW w AS (ORDER BY stat_date),
         w7 AS (ORDER BY stat_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w14 AS (ORDER BY stat_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)
),
feat_y AS (SELECT *, ln(greatest(total_kwh / roll14_kwh, 0.001)) AS y FROM feat),
rows_ AS (
  SELECT *, CAST(row_number() OVER (ORDER BY stat_date) - 1 AS INTEGER) AS pos,
         count(*) OVER () AS n_rows
  FROM feat_y WHERE roll14_kwh IS NOT NULL AND lag14_kwh IS NOT NULL
),
split_rows AS (
  SELECT *, CASE WHEN pos < floor(n_rows * 0.8) THEN 'train' ELSE 'test' END AS split FROM rows_
),
naive AS (
  SELECT 'naive_lag7' AS model, stat_date, pos, split, total_kwh, lag7_kwh AS pred FROM split_rows
  UNION ALL
  SELECT 'naive_anchor14', stat_date, pos, split, total_kwh, roll14_kwh FROM split_rows
),
folds AS (
  SELECT CAST((i - 110) / 21 AS INTEGER) AS fold, CAST(i AS INTEGER) AS train_end,
         CAST(least(i + 21, (SELECT count(*) FROM rows_)) AS INTEGER) AS test_end
  FROM range(110, (SELECT count(*) FROM rows_) - 5 + 1, 21) r(i)
),
fold_mae AS (
  SELECT n.model, f.fold, avg(abs(n.total_kwh - n.pred)) AS mae
  FROM naive n JOIN folds f ON n.pos >= f.train_end AND n.pos < f.test_end
  GROUP BY n.model, f.fold
),
wf AS (
  SELECT model, avg(mae) AS wf_mae, stddev_pop(mae) AS wf_std, count(*) AS folds FROM fold_mae GROUP BY model
),
sess_model AS (
  SELECT regr_slope(sessions, total_kwh) AS slope, regr_intercept(sessions, total_kwh) AS intercept FROM daily
),
profile AS (
  SELECT dow, avg(total_kwh / roll14_kwh) AS ratio FROM feat WHERE roll14_kwh IS NOT NULL GROUP BY dow
),
fut AS (
  SELECT CAST(i AS INTEGER) AS i, CAST((SELECT max(stat_date) FROM daily) + CAST(i AS INTEGER) AS DATE) AS stat_date,
         CAST((SELECT max(t) FROM base) + i AS INTEGER) AS t
  FROM range(1, 8) r(i)
),
fut_flags AS (
  SELECT f.i, f.stat_date, f.t, CAST(isodow(f.stat_date) - 1 AS INTEGER) AS dow,
    CAST(c.cal_date IS NOT NULL AND NOT c.is_workday AND c.holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
    CAST(CASE WHEN c.cal_date IS NOT NULL THEN NOT c.is_workday ELSE isodow(f.stat_date) >= 6 END AS INTEGER) AS is_rest
  FROM fut f LEFT JOIN calendar c ON f.stat_date = c.cal_date
),
fr AS (SELECT u.i, u.stat_date, u.is_holiday, p.ratio FROM fut_flags u JOIN profile p ON u.dow = p.dow),
hist AS (
  SELECT list(total_kwh ORDER BY stat_date) AS h
  FROM (SELECT stat_date, total_kwh FROM daily ORDER BY stat_date DESC LIMIT 14) x
),
rec(i, stat_date, h, anchor, ratio, pred) AS (
  SELECT 0, CAST(NULL AS DATE), (SELECT h FROM hist), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
  UNION ALL
  SELECT fr.i, fr.stat_date,
    list_slice(list_append(rec.h, list_avg(rec.h) * least(greatest(fr.ratio, 0), 3)),
               greatest(len(rec.h) + 1 - 14 + 1, 1), len(rec.h) + 1),
    list_avg(rec.h), fr.ratio, list_avg(rec.h) * least(greatest(fr.ratio, 0), 3)
  FROM rec JOIN fr ON fr.i = rec.i + 1
),
forecast AS (
  SELECT r.stat_date, r.anchor, r.ratio, r.pred, fr.is_holiday,
         greatest(m.intercept + m.slope * r.pred, 0) AS pred_sessions
  FROM rec r JOIN fr ON r.i = fr.i, sess_model m WHERE r.i > 0
),
hist_pts AS (
  SELECT strftime(stat_date, '%Y-%m-%d') AS date, total_kwh AS energy, CAST(sessions AS DOUBLE) AS sessions
  FROM (SELECT * FROM daily ORDER BY stat_date DESC LIMIT 14) x
),
fc_pts AS (
  SELECT strftime(stat_date, '%Y-%m-%d') AS date, round(pred, 1) AS energy,
         round(pred_sessions, 1) AS sessions FROM forecast
)"""


def sql(body: str, round_cols=(), digits: int = 4) -> str:
    q = "WITH RECURSIVE " + SERIES.strip() + "\n" + body
    return O.rounded(q, list(round_cols), digits)


# ------------------------------------------------------------------ Spark side helpers
class Series:
    """Lazily built series frames for one fixture directory."""

    def __init__(self, spark, sf_dir):
        self.w = Inputs(spark, sf_dir)
        self.spark = spark
        # The daily series (one row per day) is written once to the shared
        # folder: the forecast branches (tail, profile, future frame, session
        # model, calendar years) read it instead of rescanning the orders.
        self.daily = materialize(SR.daily_series(self.w.order_sessions))
        self.calendar = work_calendar(self.daily)
        self.features = FE.build_features(self.daily, self.calendar)
        self.rows = FE.experiment_rows(self.features)
        self.training = FE.training_rows(self.features)
        self.split_rows = SR.time_split(self.rows)

    def panel(self):
        d = materialize(SR.daily_series(self.w.order_sessions, PANEL_KEYS))
        return d, FE.build_features(d, work_calendar(d), PANEL_KEYS)

    def naive(self):
        return FC.naive_predictions(self.split_rows)

    def fold_table(self):
        return SR.folds(self.rows)

    def forecast(self, days: int = HORIZON):
        fut = FC.future_frame(self.features, days, self.calendar)
        prof = FC.dow_ratio_profile(self.features)
        # prof: 7 rows (one per weekday); ratios: one row per forecast day (<= 366)
        # a weekday without history keeps its day, with an unknown value
        ratios = fut.join(F.broadcast(prof), "dow", "left").select(SR.DATE, "ratio", "is_holiday")
        fc = FC.recursive_forecast(self.daily, ratios.select(SR.DATE, "ratio"))
        sm = FC.session_model(self.daily)
        fc = fc.join(F.broadcast(ratios.select(SR.DATE, "is_holiday")), SR.DATE)
        return (fc.withColumn("_k", F.lit(1)).join(F.broadcast(sm.withColumn("_k", F.lit(1))), "_k")
                .select(SR.DATE, "anchor", "ratio", "pred", "is_holiday",
                        FC.estimate_sessions("pred").alias("pred_sessions")))

    def points(self, days: int = HORIZON):
        hist = FC.history_tail(self.daily).select(
            F.date_format(SR.DATE, "yyyy-MM-dd").alias("date"), F.col("total_kwh").alias("energy"),
            F.col("sessions").cast("double").alias("sessions"))
        fc = self.forecast(days).select(
            F.date_format(SR.DATE, "yyyy-MM-dd").alias("date"), C.round_half_up("pred", 1).alias("energy"),
            C.round_half_up("pred_sessions", 1).alias("sessions"))
        return hist, fc


def _s(spark, sf_dir) -> Series:
    return Series(spark, sf_dir)


DAILY_COLS = ["total_kwh", "total_fee"]


# ------------------------------------------------------------------ A16, S6, S13, F7, F15
@register("daily_series", sql("SELECT * FROM daily", DAILY_COLS))
def daily_series(spark, sf_dir):
    # one consumer: the aggregate itself, without the shared materialised copy
    return stable(SR.daily_series(Inputs(spark, sf_dir).order_sessions))


@register("panel_series", sql("""
SELECT priority, CAST(started AS DATE) AS stat_date, count(*) AS sessions, sum(energy) AS total_kwh,
       sum(fees) AS total_fee, count(DISTINCT station) AS active_stations
FROM orders_s GROUP BY 1, 2""", DAILY_COLS))
def panel_series(spark, sf_dir):
    return stable(SR.daily_series(Inputs(spark, sf_dir).order_sessions, PANEL_KEYS))


# Fixed column comments of the typed daily-series table.
SERIES_COMMENTS = {"stat_date": "statistics date (day of the session start)",
                   "sessions": "sessions that day", "total_kwh": "energy that day (kWh), forecast target",
                   "total_fee": "fees that day", "active_stations": "stations with at least one session"}


@register("orc_roundtrip", sql("SELECT * FROM daily", DAILY_COLS))
def orc_roundtrip(spark, sf_dir):
    """Typed table with column comments stored as ORC, then read back."""
    path = scratch_path(spark, "daily-series-orc")
    RAW.write_typed_orc(_s(spark, sf_dir).daily, path, SERIES_COMMENTS)
    return stable(RAW.read_typed_orc(spark, path))


@register("series_load", sql("SELECT * FROM daily", DAILY_COLS))
def series_load(spark, sf_dir):
    return stable(SR.load_series(_s(spark, sf_dir).daily, ordered=True))


@register("reconcile_daily", sql("""
SELECT CAST(sum(sessions) AS BIGINT) AS daily_sessions, (SELECT count(*) FROM orders_s) AS total_sessions,
       CAST(sum(sessions) AS BIGINT) = (SELECT count(*) FROM orders_s) AS reconciled FROM daily"""))
def reconcile_daily(spark, sf_dir):
    s = _s(spark, sf_dir)
    return Q.reconcile_daily(s.daily, s.w.order_sessions)


@register("series_audit", sql("""
SELECT 'daily rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM daily
UNION ALL SELECT 'min date', CAST(min(stat_date) AS VARCHAR) FROM daily
UNION ALL SELECT 'max date', CAST(max(stat_date) AS VARCHAR) FROM daily
UNION ALL SELECT 'sessions_total', CAST(sum(sessions) AS VARCHAR) FROM daily
UNION ALL SELECT 'kwh_total', CAST(CAST(round(sum(total_kwh), 1) AS DECIMAL(38, 1)) AS VARCHAR) FROM daily"""))
def series_audit(spark, sf_dir):
    return SR.audit(_s(spark, sf_dir).daily)


# ------------------------------------------------------------------ W1-W5, J2, P16-P18, F11, A22
@register("series_index", sql("SELECT stat_date, t FROM base"))
def series_index(spark, sf_dir):
    return SR.add_index(_s(spark, sf_dir).daily).select(SR.DATE, "t")


_LAG_COLS = [f"lag{k}_kwh" for k in SR.LAGS]


@register("series_lags", sql(f"SELECT stat_date, {', '.join(_LAG_COLS)} FROM feat", _LAG_COLS))
def series_lags(spark, sf_dir):
    return stable(SR.add_lags(_s(spark, sf_dir).daily).select(SR.DATE, *_LAG_COLS))


@register("rolling_mean_7", sql("SELECT stat_date, roll7_kwh FROM feat", ["roll7_kwh"]))
def rolling_mean_7(spark, sf_dir):
    return stable(SR.add_rolling(_s(spark, sf_dir).daily, 7).select(SR.DATE, "roll7_kwh"))


@register("rolling_anchor_14", sql("SELECT stat_date, roll14_kwh FROM feat", ["roll14_kwh"]))
def rolling_anchor_14(spark, sf_dir):
    return stable(SR.add_rolling(_s(spark, sf_dir).daily, 14).select(SR.DATE, "roll14_kwh"))


@register("time_split", sql("SELECT stat_date, pos, split FROM split_rows"))
def time_split(spark, sf_dir):
    return _s(spark, sf_dir).split_rows.select(SR.DATE, "pos", "split")


@register("walk_forward_folds", sql("""
SELECT f.fold, f.train_end, f.test_end, count(*) AS test_rows, min(r.stat_date) AS test_first,
       max(r.stat_date) AS test_last
FROM folds f JOIN rows_ r ON r.pos >= f.train_end AND r.pos < f.test_end
GROUP BY f.fold, f.train_end, f.test_end"""))
def walk_forward_folds(spark, sf_dir):
    s = _s(spark, sf_dir)
    t = SR.test_rows_by_fold(s.rows, s.fold_table())
    return t.groupBy("fold", "train_end", "test_end").agg(
        F.count(F.lit(1)).alias("test_rows"), F.min(SR.DATE).alias("test_first"), F.max(SR.DATE).alias("test_last"))


for _flag in ("rest", "holiday", "makeup"):
    def _mk(flag):
        def q(spark, sf_dir):
            s = _s(spark, sf_dir)
            return CAL.with_calendar(s.daily.select(SR.DATE), s.calendar).select(SR.DATE, f"is_{flag}")
        return q
    register(f"calendar_{_flag}", sql(f"SELECT stat_date, is_{_flag} FROM flagged"))(_mk(_flag))

_CAL_COLS = ["dow", "is_weekend", "month"] + [f"dow_{k}" for k in range(7)]


@register("calendar_features", sql(f"SELECT stat_date, {', '.join(_CAL_COLS)} FROM feat"))
def calendar_features(spark, sf_dir):
    d = SR.daily_series(Inputs(spark, sf_dir).order_sessions)   # one consumer
    return d.select(SR.DATE, *C.calendar_feature_columns(SR.DATE))


@register("log_ratio_target", sql("SELECT stat_date, total_kwh, roll14_kwh, y FROM feat_y WHERE roll14_kwh IS NOT NULL",
                                  ["total_kwh", "roll14_kwh", "y"], 6))
def log_ratio_target(spark, sf_dir):
    f = _s(spark, sf_dir).features
    return stable(f.filter(F.col("roll14_kwh").isNotNull()).select(SR.DATE, "total_kwh", "roll14_kwh", "y"), 6)


@register("ratio_inverse", sql("""
SELECT stat_date, roll14_kwh * least(greatest(exp(y), 0), 3) AS restored_log,
       roll14_kwh * least(greatest(total_kwh / roll14_kwh, 0), 3) AS restored_plain
FROM feat_y WHERE roll14_kwh IS NOT NULL""", ["restored_log", "restored_plain"], 2))
def ratio_inverse(spark, sf_dir):
    f = _s(spark, sf_dir).features.filter(F.col("roll14_kwh").isNotNull())
    return stable(f.select(SR.DATE, C.ratio_inverse("y", "roll14_kwh", True).alias("restored_log"),
                           C.ratio_inverse(F.col("total_kwh") / F.col("roll14_kwh"), "roll14_kwh", False)
                           .alias("restored_plain")), 2)


_FEAT_DOUBLES = ["total_kwh", "total_fee"] + _LAG_COLS + ["roll7_kwh", "roll14_kwh"]


@register("feature_rows", sql(f"""
SELECT stat_date, pos, t, sessions, active_stations, {', '.join(FE.FEATURE_COLUMNS[1:])}, total_kwh, total_fee
FROM rows_""", _FEAT_DOUBLES))
def feature_rows(spark, sf_dir):
    r = _s(spark, sf_dir).rows
    return stable(r.select(SR.DATE, "pos", "t", "sessions", "active_stations", *FE.FEATURE_COLUMNS[1:],
                           "total_kwh", "total_fee"))


@register("split_summary", sql("""
SELECT split, count(*) AS "rows", min(stat_date) AS first_date, max(stat_date) AS last_date,
       avg(total_kwh) AS mean_target FROM split_rows GROUP BY split""", ["mean_target"]))
def split_summary(spark, sf_dir):
    return stable(SR.split_summary(_s(spark, sf_dir).split_rows))


# ------------------------------------------------------------------ M2, M9, A17-A20
for _m in FC.NAIVE:
    def _mkn(model):
        def q(spark, sf_dir):
            n = _s(spark, sf_dir).naive()
            return stable(n.filter((F.col("model") == model) & (F.col("split") == "test"))
                          .select(SR.DATE, "total_kwh", "pred"))
        return q
    register(_m, sql(f"SELECT stat_date, total_kwh, pred FROM naive WHERE model = '{_m}' AND split = 'test'",
                     ["total_kwh", "pred"]))(_mkn(_m))


@register("forecast_metrics", sql("""
SELECT model, avg(abs(total_kwh - pred)) AS mae, sqrt(avg(pow(total_kwh - pred, 2))) AS rmse,
       avg(2 * abs(total_kwh - pred) / (abs(total_kwh) + abs(pred) + 1e-9)) * 100 AS smape
FROM naive WHERE split = 'test' GROUP BY model""", ["mae", "rmse", "smape"]))
def forecast_metrics(spark, sf_dir):
    n = _s(spark, sf_dir).naive().filter(F.col("split") == "test")
    return stable(FC.metrics(n))


@register("walk_forward_naive", sql("SELECT * FROM wf", ["wf_mae", "wf_std"]))
def walk_forward_naive(spark, sf_dir):
    s = _s(spark, sf_dir)
    return stable(FC.fold_summary(FC.walk_forward_errors(s.naive(), s.fold_table())))


@register("model_select", sql("SELECT min_by(model, wf_mae) AS model, min(wf_mae) AS wf_mae FROM wf", ["wf_mae"]))
def model_select(spark, sf_dir):
    s = _s(spark, sf_dir)
    return stable(FC.select_best(FC.fold_summary(FC.walk_forward_errors(s.naive(), s.fold_table()))))


@register("session_estimate", sql("""
SELECT stat_date, sessions, greatest(m.intercept + m.slope * total_kwh, 0) AS est_sessions
FROM daily, sess_model m""", ["est_sessions"]))
def session_estimate(spark, sf_dir):
    d = _s(spark, sf_dir).daily
    sm = FC.session_model(d).withColumn("_k", F.lit(1))
    return stable(d.withColumn("_k", F.lit(1)).join(F.broadcast(sm), "_k")
                  .select(SR.DATE, "sessions", FC.estimate_sessions("total_kwh").alias("est_sessions")))


# ------------------------------------------------------------------ W6-W9, P20, M12, S12
@register("future_frame", sql("SELECT stat_date, t, dow, is_holiday, is_rest FROM fut_flags"))
def future_frame(spark, sf_dir):
    s = _s(spark, sf_dir)
    return FC.future_frame(s.features, HORIZON, s.calendar)


@register("recursive_forecast", sql("SELECT stat_date, anchor, ratio, pred FROM forecast",
                                    ["anchor", "ratio", "pred"]))
def recursive_forecast(spark, sf_dir):
    return stable(_s(spark, sf_dir).forecast().select(SR.DATE, "anchor", "ratio", "pred"))


@register("history_tail", sql("SELECT stat_date, total_kwh, sessions FROM daily ORDER BY stat_date DESC LIMIT 14",
                              ["total_kwh"]))
def history_tail(spark, sf_dir):
    return stable(FC.history_tail(_s(spark, sf_dir).daily).select(SR.DATE, "total_kwh", "sessions"))


_REPORT_SQL = sql("""
SELECT strftime(stat_date, '%Y-%m-%d') AS forecast_date, strftime(stat_date, '%a') AS weekday, is_holiday,
       round(pred, 1) AS pred_kwh, round(pred_sessions, 1) AS pred_sessions
FROM forecast""")


@register("forecast_report", _REPORT_SQL)
def forecast_report(spark, sf_dir):
    return FC.forecast_report(_s(spark, sf_dir).forecast())


@register("forecast_csv", _REPORT_SQL)
def forecast_csv(spark, sf_dir):
    """The report written as CSV and read back with its types."""
    report = FC.forecast_report(_s(spark, sf_dir).forecast())
    path = scratch_path(spark, "forecast-csv")
    RAW.write_report(report, path)
    return RAW.read_report(spark, path, report.schema)


@register("forecast_bridge", sql("""
SELECT date, 'history' AS role, energy AS value FROM hist_pts
UNION ALL SELECT date, 'forecast', energy FROM fc_pts
UNION ALL SELECT * FROM (SELECT date, 'forecast', energy FROM hist_pts ORDER BY date DESC LIMIT 1)""", ["value"]))
def forecast_bridge(spark, sf_dir):
    h, f = _s(spark, sf_dir).points()
    return stable(FC.bridge(h, f, "energy"))


@register("forecast_payload", sql("""
SELECT 'history' AS part, date, energy, sessions FROM hist_pts
UNION ALL SELECT 'forecast', date, energy, sessions FROM fc_pts""", ["energy", "sessions"]))
def forecast_payload(spark, sf_dir):
    """M12 on exploded values: the JSON document is built, parsed back and flattened."""
    s = _s(spark, sf_dir)
    h, f = s.points()
    doc = FC.forecast_payload(h, f, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    schema = doc.select("doc").schema["doc"].dataType
    parsed = doc.select(F.from_json("payload", schema).alias("d"))
    hist = parsed.select(F.lit("history").alias("part"), F.inline("d.history"))
    fc = parsed.select(F.lit("forecast").alias("part"), F.inline("d.forecast"))
    return stable(hist.unionByName(fc))


# ------------------------------------------------------------------ panel (many series)
@register("panel_lags", sql("""
SELECT priority, stat_date, CAST(row_number() OVER w - 1 AS INTEGER) AS t, lag(total_kwh, 7) OVER w AS lag7_kwh,
       CASE WHEN count(total_kwh) OVER w14 = 14 THEN avg(total_kwh) OVER w14 END AS roll14_kwh
FROM (SELECT priority, CAST(started AS DATE) AS stat_date, sum(energy) AS total_kwh FROM orders_s GROUP BY 1, 2) p
WINDOW w AS (PARTITION BY priority ORDER BY stat_date),
       w14 AS (PARTITION BY priority ORDER BY stat_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""",
    ["lag7_kwh", "roll14_kwh"]))
def panel_lags(spark, sf_dir):
    _, f = _s(spark, sf_dir).panel()
    return stable(f.select("priority", SR.DATE, "t", "lag7_kwh", "roll14_kwh"))


PANEL = """
pd AS (SELECT priority, CAST(started AS DATE) AS stat_date, sum(energy) AS total_kwh FROM orders_s GROUP BY 1, 2),
pfeat AS (
  SELECT *, CAST(isodow(stat_date) - 1 AS INTEGER) AS dow,
         CASE WHEN count(total_kwh) OVER w14 = 14 THEN avg(total_kwh) OVER w14 END AS roll14_kwh
  FROM pd WINDOW w14 AS (PARTITION BY priority ORDER BY stat_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)
),
pprof AS (SELECT priority, dow, avg(total_kwh / roll14_kwh) AS ratio FROM pfeat
          WHERE roll14_kwh IS NOT NULL GROUP BY 1, 2),
plast AS (SELECT priority, max(stat_date) AS last FROM pd GROUP BY 1),
pfut AS (SELECT l.priority, CAST(r.i AS INTEGER) AS i, CAST(l.last + CAST(r.i AS INTEGER) AS DATE) AS stat_date
         FROM plast l, range(1, 8) r(i)),
pfr AS (SELECT u.priority, u.i, u.stat_date, p.ratio FROM pfut u
        JOIN pprof p ON u.priority = p.priority AND CAST(isodow(u.stat_date) - 1 AS INTEGER) = p.dow),
phist AS (
  SELECT priority, list(total_kwh ORDER BY stat_date) AS h
  FROM (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY stat_date DESC) AS rn FROM pd) x
  WHERE rn <= 14 GROUP BY priority
),
prec(priority, i, stat_date, h, anchor, ratio, pred) AS (
  SELECT priority, 0, CAST(NULL AS DATE), h, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
  FROM phist
  UNION ALL
  SELECT r.priority, f.i, f.stat_date,
    list_slice(list_append(r.h, list_avg(r.h) * least(greatest(f.ratio, 0), 3)),
               greatest(len(r.h) + 1 - 14 + 1, 1), len(r.h) + 1),
    list_avg(r.h), f.ratio, list_avg(r.h) * least(greatest(f.ratio, 0), 3)
  FROM prec r JOIN pfr f ON f.priority = r.priority AND f.i = r.i + 1
)"""


@register("panel_forecast", O.rounded("WITH RECURSIVE " + SERIES.strip() + "," + PANEL + """
SELECT priority, stat_date, anchor, ratio, pred FROM prec WHERE i > 0""", ["anchor", "ratio", "pred"]))
def panel_forecast(spark, sf_dir):
    """W6 for many series at once: one fold per series, all series in parallel."""
    s = _s(spark, sf_dir)
    d, f = s.panel()
    cal = work_calendar(d)
    fut = FC.future_frame(f, HORIZON, cal, PANEL_KEYS)
    prof = FC.dow_ratio_profile(f, PANEL_KEYS)
    ratios = fut.join(prof, [*PANEL_KEYS, "dow"], "left").select(*PANEL_KEYS, SR.DATE, "ratio")
    return stable(FC.recursive_forecast(d, ratios, PANEL_KEYS))
