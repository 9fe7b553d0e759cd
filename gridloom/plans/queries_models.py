"""Model queries. Ridge is checked by SQL; randomized or iterative fits by their
own tests and a rows check."""
from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import features as FE
from gridloom.operators import forecast as FC
from gridloom.operators import linear as LN
from gridloom.operators import models as MD
from gridloom.operators import panel as PN
from gridloom.operators import series as SR
from gridloom.plans import oracle_sql as O
from gridloom.plans.catalog import register, stable
from gridloom.plans.queries_series import HORIZON, PANEL_KEYS, SERIES, Series
from gridloom.session import materialize, scratch_path
from gridloom.sources.fixtures import work_calendar


def _candidate(name):
    return next(c for c in MD.candidates() if c.name == name)


def _test_metrics(name):
    def q(spark, sf_dir):
        return stable(MD.final_metrics(materialize(Series(spark, sf_dir).rows), _candidate(name)))
    return q


for _q, _c in (("gbt_ratio", "gbr_ratio14"), ("gbt_ratio_cal", "gbr_ratio14_cal"),
               ("rf_ratio", "rf_ratio14"), ("ensemble_ratio_ridge", "ens_ratio14_lin")):
    register(_q)(_test_metrics(_c))


# ------------------------------------------------------------------ ridge (M3)
#: Rows of every panel series with the features of the trend model.
PANEL_ROWS = """
pdaily AS (SELECT priority, CAST(started AS DATE) AS stat_date, sum(energy) AS total_kwh FROM orders_s GROUP BY 1, 2),
pbase AS (SELECT *, CAST(row_number() OVER (PARTITION BY priority ORDER BY stat_date) - 1 AS INTEGER) AS t,
                 CAST(isodow(stat_date) - 1 AS INTEGER) AS dow FROM pdaily),
pflag AS (
  SELECT b.*, CAST(CASE WHEN c.cal_date IS NOT NULL THEN NOT c.is_workday ELSE b.dow >= 5 END AS INTEGER) AS is_rest,
         CAST(c.cal_date IS NOT NULL AND NOT c.is_workday AND c.holiday_name IS NOT NULL AS INTEGER) AS is_holiday
  FROM pbase b LEFT JOIN calendar c ON b.stat_date = c.cal_date
),
ridge_rows AS (
  SELECT priority, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY priority) AS n, total_kwh AS y, t,
         CAST(dow = 0 AS INTEGER) AS dow_0, CAST(dow = 1 AS INTEGER) AS dow_1, CAST(dow = 2 AS INTEGER) AS dow_2,
         CAST(dow = 3 AS INTEGER) AS dow_3, CAST(dow = 4 AS INTEGER) AS dow_4, CAST(dow = 5 AS INTEGER) AS dow_5,
         CAST(dow = 6 AS INTEGER) AS dow_6, is_holiday, is_rest
  FROM pflag WHERE t >= 14 WINDOW w AS (PARTITION BY priority ORDER BY stat_date)
),"""

ONE_ROWS = """
ridge_rows AS (SELECT 'all' AS priority, pos, n_rows AS n, total_kwh AS y, t, dow_0, dow_1, dow_2, dow_3, dow_4, dow_5,
                      dow_6, is_holiday, is_rest FROM rows_),"""

#: Normal equations of every series, solved by elimination one pivot a step.
RIDGE = """
rx AS (SELECT priority, pos, n, y, pos < floor(n * 0.8) AS train,
              unnest(CAST([t, dow_0, dow_1, dow_2, dow_3, dow_4, dow_5, dow_6, is_holiday, is_rest] AS DOUBLE[])) AS v,
              unnest(range(1, 11)) AS i FROM ridge_rows),
rmid AS (SELECT priority, i, avg(v) AS mv, avg(y) AS my FROM rx WHERE train GROUP BY 1, 2),
rcen AS (SELECT x.priority, x.pos, x.i, x.v - m.mv AS v, x.y - m.my AS y
         FROM rx x JOIN rmid m USING (priority, i) WHERE x.train),
rsys AS (SELECT a.priority, a.i, b.i AS j, sum(a.v * b.v) + CASE WHEN a.i = b.i THEN 1 ELSE 0 END AS v
         FROM rcen a JOIN rcen b USING (priority, pos) GROUP BY 1, 2, 3
         UNION ALL SELECT priority, i, 11, sum(v * y) FROM rcen GROUP BY 1, 2),
rel(priority, k, i, j, v) AS (
  SELECT priority, 0, i, j, v FROM rsys
  UNION ALL
  SELECT priority, k + 1, i, j,
    CASE WHEN i = k + 1 THEN v / head ELSE v - own_lead / head * above_v END
  FROM (
    SELECT *, max(CASE WHEN i = k + 1 AND j = k + 1 THEN v END) OVER (PARTITION BY priority) AS head,
           max(CASE WHEN j = k + 1 THEN v END) OVER (PARTITION BY priority, i) AS own_lead,
           max(CASE WHEN i = k + 1 THEN v END) OVER (PARTITION BY priority, j) AS above_v
    FROM rel WHERE k < 10
  ) q
),
rslope AS (SELECT priority, i, v AS b FROM rel WHERE k = 10 AND j = 11),
rpred AS (
  SELECT x.priority, x.pos, any_value(x.y) AS y, any_value(m.my) + sum((x.v - m.mv) * s.b) AS pred
  FROM rx x JOIN rmid m USING (priority, i) JOIN rslope s USING (priority, i) WHERE NOT x.train GROUP BY 1, 2
),
rmetric AS (
  SELECT priority, avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) * (y - pred))) AS rmse,
         avg(2 * abs(y - pred) / (abs(y) + abs(pred) + 1e-9)) * 100 AS smape
  FROM rpred GROUP BY 1
)"""


def _ridge_metrics(rows, keys=()):
    """Metrics of the trend model on the last fifth of every series, fitted on the rest."""
    rows = materialize(SR.time_split(rows, keys))
    fitted = LN.coefficients(rows.filter("split = 'train'"), FE.F_LIN, SR.TARGET, keys)
    pred = LN.predict(rows.filter("split = 'test'"), fitted, FE.F_LIN, keys)
    return FC.metrics(pred.withColumn("model", F.lit("lin_trend")), by=(*keys, "model"))


def _ridge_sql(rows: str, keys: str) -> str:
    return O.rounded("WITH RECURSIVE " + SERIES.strip().rstrip(",") + "," + rows + RIDGE
                     + f" SELECT {keys} 'lin_trend' AS model, mae, rmse, smape FROM rmetric", ["mae", "rmse", "smape"])


@register("ridge_trend", _ridge_sql(ONE_ROWS, ""))
def ridge_trend(spark, sf_dir):
    """M3: test metrics of the ridge trend model."""
    return stable(_ridge_metrics(Series(spark, sf_dir).rows))


@register("panel_ridge", _ridge_sql(PANEL_ROWS, "priority,"))
def panel_ridge(spark, sf_dir):
    """M3 for many series: all normal equations from one aggregate."""
    _, f = Series(spark, sf_dir).panel()
    return stable(_ridge_metrics(FE.experiment_rows(f, PANEL_KEYS), PANEL_KEYS))


@register("panel_model_forecast")
def panel_model_forecast(spark, sf_dir):
    """M1 + M11 + W6 for many series: trees of every series saved as rows, read back and folded into its forecast."""
    d, f = Series(spark, sf_dir).panel()
    rows = FE.training_rows(f, PANEL_KEYS)
    p = MD.GBT_PARAMS
    model = PN.fit(rows, PANEL_KEYS, FE.DEPLOYED_FEATURES, "y", p["maxIter"], p["maxDepth"], p["stepSize"])
    path = scratch_path(spark, "panel-model")
    model = PN.PanelModel.load(spark, path, model.save(path))
    return stable(PN.forecast(model, d, FC.future_frame(f, HORIZON, work_calendar(d), PANEL_KEYS)))


@register("gbt_logratio")
def gbt_logratio(spark, sf_dir):
    """M1: the deployed log-ratio model's test metrics next to the 14-row mean."""
    report, _ = MD.train_deployed(Series(spark, sf_dir).training)
    return stable(report)


@register("model_compare")
def model_compare(spark, sf_dir):
    """Walk-forward metrics over every fold, and final-test metrics, of every candidate."""
    return stable(MD.compare(Series(spark, sf_dir).rows, MD.candidates()))


@register("gbt_forecast")
def gbt_forecast(spark, sf_dir):
    """M11 + W6: train on all rows, save and reload the bundle, forecast the
    next days recursively, estimate sessions (report rows as in the CSV copy)."""
    s = Series(spark, sf_dir)
    _, bundle = MD.train_deployed(s.training)
    path = scratch_path(spark, "model")
    bundle.save(spark, path)
    bundle = MD.Bundle.load(spark, path)
    fut = FC.future_frame(s.features, HORIZON, s.calendar)
    fc = MD.forecast_with(bundle, s.daily, fut)
    sm = FC.session_model(s.daily).withColumn("_k", F.lit(1))
    fc = (fc.join(fut.select(SR.DATE, "is_holiday"), SR.DATE).withColumn("_k", F.lit(1))
          .join(F.broadcast(sm), "_k").withColumn("pred_sessions", FC.estimate_sessions("pred")))
    return FC.forecast_report(fc)


@register("forecast_job")
def forecast_job(spark, sf_dir):
    """The forecasting job end to end: train, save, forecast, CSV copy and a
    validated forecast snapshot; returns the CSV rows read back."""
    from gridloom.plans import forecasting as FJ
    s = Series(spark, sf_dir)
    res = FJ.run(spark, s.daily, scratch_path(spark, "forecast-job"), s.calendar, HORIZON)
    return res.report
