"""Model queries run end to end (randomized fits: checked for shape and sanity)."""
import pytest

from conftest import SMALL

import __spark_entry__ as entry


@pytest.mark.parametrize("name", ["ridge_trend", "gbt_ratio", "gbt_ratio_cal", "rf_ratio",
                                  "ensemble_ratio_ridge", "gbt_logratio"])
def test_candidate_metrics(spark, name):
    rows = entry.queries()[name](spark, SMALL).collect()
    assert rows and all(r["mae"] >= 0 and 0 <= r["smape"] <= 200 for r in rows)


def test_model_forecast_and_job(spark):
    rep = entry.queries()["gbt_forecast"](spark, SMALL).collect()
    assert len(rep) == 7 and all(r["pred_kwh"] >= 0 and r["pred_sessions"] >= 0 for r in rep)
    job = entry.queries()["forecast_job"](spark, SMALL).collect()
    assert len(job) == 7


def test_snapshot_ready(spark):
    r = entry.queries()["snapshot_ready"](spark, SMALL).first()
    assert r["status"] == "ok" and r["version"] == 1
