"""The forecasting job: daily series -> features -> deployed model -> recursive
forecast -> CSV copy + validated forecast snapshot (M1, M11, M12, W6-W9, S12).

The daily series has one row per (series keys, day); everything after the
series build is bounded by the number of days, and the recursion keeps one
row per series. The model bundle and every output live in shared storage.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators import features as FE
from gridloom.operators import forecast as FC
from gridloom.operators import models as MD
from gridloom.operators import series as SR
from gridloom.sources import raw as RAW
from gridloom.sources import snapshot as SN


@dataclass
class ForecastResult:
    report: DataFrame
    metrics: DataFrame
    snapshot_version: int


def run(spark: SparkSession, daily: DataFrame, root: str, calendar: DataFrame, days: int = 7,
        gbt_params: dict | None = None) -> ForecastResult:
    """``calendar``: cal_date, is_workday, holiday_name of the exceptions to "weekends rest"."""
    days = FC.check_horizon(days)
    base = root.rstrip("/")
    daily = SR.load_series(daily)
    features = FE.build_features(daily, calendar)
    rows = FE.training_rows(features)
    metrics, bundle = MD.train_deployed(rows, gbt_params)
    metrics.write.mode("overwrite").parquet(f"{base}/ml/metrics")
    saved = bundle.save(spark, f"{base}/ml/bundle")
    bundle = MD.Bundle.load(spark, f"{base}/ml/bundle", saved)

    fut = FC.future_frame(features, days, calendar)
    fc = MD.forecast_with(bundle, daily, fut)
    sm = FC.session_model(daily).withColumn("_k", F.lit(1))
    fc = (fc.join(fut.select(SR.DATE, "is_holiday"), SR.DATE).withColumn("_k", F.lit(1))
          .join(F.broadcast(sm), "_k").withColumn("pred_sessions", FC.estimate_sessions("pred")))
    report = FC.forecast_report(fc)
    RAW.write_report(report, f"{base}/ml/forecast_csv")

    hist = FC.history_tail(daily).select(F.date_format(SR.DATE, "yyyy-MM-dd").alias("date"),
                                         F.col("total_kwh").alias("energy"),
                                         F.col("sessions").cast("double").alias("sessions"))
    fpts = fc.select(F.date_format(SR.DATE, "yyyy-MM-dd").alias("date"),
                     C.round_half_up("pred", 1).alias("energy"),
                     C.round_half_up("pred_sessions", 1).alias("sessions"))
    gen = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    doc = FC.forecast_payload(hist, fpts, gen)
    version = SN.publish(doc.select(F.col("doc.generated_at").alias("generated_at"), "payload"),
                         f"{base}/snapshots", "forecast", checks=FC.payload_check(doc))
    return ForecastResult(spark.read.option("header", True).csv(f"{base}/ml/forecast_csv"),
                          spark.read.parquet(f"{base}/ml/metrics"), version)
