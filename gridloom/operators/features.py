"""Feature tables for the load models.

All row-based windows share one ``partitionBy(keys).orderBy(stat_date)``
specification, so Spark evaluates them after a single shuffle and sort.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridloom.functions import columns as C
from gridloom.operators import series as SR
from gridloom.operators.calendar import with_calendar

ANCHOR = "roll14_kwh"
# Fixed feature groups of the candidates.
F_CAL = ["dow", "is_holiday", "is_rest"]
F_CAL_T = F_CAL + ["t"]
F_LIN = ["t"] + [f"dow_{k}" for k in range(7)] + ["is_holiday", "is_rest"]
DEPLOYED_FEATURES = ["t", "dow", "is_holiday", "is_rest"]


def build_features(daily: DataFrame, calendar: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Index, calendar, one-hot weekday, lags, rolling means and the log-ratio
    target. Nothing uses the current day's value except the target."""
    f = SR.add_index(daily, keys)
    f = f.select("*", *C.calendar_feature_columns(SR.DATE))
    f = with_calendar(f, calendar)
    f = SR.add_lags(f, keys)
    f = SR.add_rolling(f, SR.SHORT_WINDOW, keys)
    f = SR.add_rolling(f, SR.ANCHOR_WINDOW, keys)
    return f.withColumn("y", C.log_ratio(SR.TARGET, ANCHOR))


FEATURE_COLUMNS = (["t", "dow", "is_weekend", "month", "is_holiday", "is_rest"]
                   + [f"dow_{k}" for k in range(7)]
                   + [f"lag{k}_kwh" for k in SR.LAGS] + ["roll7_kwh", "roll14_kwh"])


def experiment_rows(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """rows with every column present, re-positioned (``pos``)."""
    f = features.dropna()
    return SR.add_position(f, keys)


def training_rows(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """rows with a full 14-row anchor (and a defined target), re-positioned."""
    f = features.dropna(subset=[ANCHOR, "y"])
    return SR.add_position(f, keys)
