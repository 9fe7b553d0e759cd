"""Ridge by normal equations and boosted trees of many series as tables."""
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL

from gridloom.operators import features as FE
from gridloom.operators import forecast as FC
from gridloom.operators import linear as LN
from gridloom.operators import panel as PN
from gridloom.operators import series as SR
from gridloom.operators import trees as TR
from gridloom.plans import catalog  # noqa: F401  registers the queries in order
from gridloom.plans.queries_series import HORIZON, PANEL_KEYS, Series
from gridloom.session import materialize
from gridloom.sources.fixtures import work_calendar


def _sample(seed, n, width):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * 10.0 ** rng.integers(-2, 4, width) + 1000
    x[:, -1] = (rng.random(n) < 0.3)
    return x, x @ rng.normal(size=width) + rng.normal(size=n)


def test_coefficients_equal_the_closed_form(spark):
    names = ["a", "b", "c"]
    rows, want = [], {}
    for key, n in (("s1", 40), ("s2", 7), (None, 20), ("one", 1)):
        x, y = _sample(n, n, 3)
        rows += [(key, *map(float, r), float(v), i) for i, (r, v) in enumerate(zip(x, y))]
        want[key] = TR.ridge(x, y, x, 1.0)
    rows += [("s1", None, 1.0, 1.0, 5.0, -1), ("s1", 1.0, 1.0, 1.0, None, -2), ("nolabel", 1.0, 2.0, 3.0, None, 0)]
    df = spark.createDataFrame(rows, "s string, a double, b double, c double, y double, i int")
    fitted = LN.coefficients(df, names, "y", ["s"])
    assert {r.s: r.rows for r in fitted.collect()} == {"s1": 40, "s2": 7, None: 20, "one": 1}
    pred = {(r.s, r.i): r.pred for r in LN.predict(df, fitted, names, ["s"]).collect()}
    assert len(pred) == len(rows)
    for key in ("s1", "s2", "one"):
        got = [pred[key, i] for i in range(len(want[key]))]
        assert np.allclose(got, want[key], rtol=1e-9)
    assert pred["s1", -1] is None and pred["s1", -2] is not None and pred["nolabel", 0] is None
    alone = df.filter("s = 's1' AND i >= 0")
    one = LN.predict(alone, LN.coefficients(alone, names, "y"), names).collect()
    assert np.allclose([r.pred for r in sorted(one, key=lambda r: r.i)], want["s1"], rtol=1e-9)


def test_no_rows_have_no_coefficients(spark):
    empty = spark.createDataFrame([], "s string, a double, y double")
    for keys in ([], ["s"]):
        fitted = LN.coefficients(empty, ["a"], "y", keys)
        assert fitted.count() == 0
        some = spark.createDataFrame([("x", 1.0, 2.0)], "s string, a double, y double")
        assert [r.pred for r in LN.predict(some, fitted, ["a"], keys).collect()] == [None]


#: A walk down every saved tree, one level a step, then the recursion day by day.
REPLAY = """
WITH RECURSIVE walk AS (
  SELECT f.*, n.tree, n.node, n.feature, n.cut, n."left", n.value FROM fut f JOIN nodes n USING (priority) WHERE n.node = 0
  UNION ALL
  SELECT w.priority, w.stat_date, w.t, w.dow, w.is_holiday, w.is_rest, n.tree, n.node, n.feature, n.cut, n."left", n.value
  FROM walk w JOIN nodes n ON n.priority = w.priority AND n.tree = w.tree AND n.node = w."left" +
    CASE WHEN CASE w.feature WHEN 0 THEN w.t WHEN 1 THEN w.dow WHEN 2 THEN w.is_holiday ELSE w.is_rest END > w.cut
    THEN 1 ELSE 0 END
  WHERE w.feature >= 0
),
ratio AS (SELECT priority, stat_date, exp(sum(CASE WHEN tree < 0 THEN value ELSE 0.1 * value END)) AS ratio
          FROM walk WHERE feature < 0 GROUP BY 1, 2),
nth AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY stat_date) AS i FROM ratio),
rec(priority, i, stat_date, h, pred) AS (
  SELECT priority, 0, CAST(NULL AS DATE), list(total_kwh ORDER BY stat_date), CAST(NULL AS DOUBLE)
  FROM (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY stat_date DESC) AS rn FROM daily) WHERE rn <= 14 GROUP BY 1
  UNION ALL
  SELECT r.priority, n.i, n.stat_date,
         list_slice(list_append(r.h, list_avg(r.h) * least(greatest(n.ratio, 0), 3)), greatest(len(r.h) - 12, 1), len(r.h) + 1),
         list_avg(r.h) * least(greatest(n.ratio, 0), 3)
  FROM rec r JOIN nth n ON n.priority = r.priority AND n.i = r.i + 1
)
SELECT priority, stat_date, pred FROM rec WHERE i > 0 ORDER BY 1, 2"""


def test_forecast_is_replayed_from_the_saved_nodes(spark, tmp_path):
    d, f = Series(spark, SMALL).panel()
    rows = materialize(FE.training_rows(f, PANEL_KEYS))
    path = str(tmp_path / "model")
    fitted = PN.fit(rows, PANEL_KEYS, FE.DEPLOYED_FEATURES, "y", 30, 3, 0.1)
    assert fitted.save(path) == 1
    model = PN.PanelModel.load(spark, path)
    future = materialize(FC.future_frame(f, HORIZON, work_calendar(d), PANEL_KEYS))
    got = sorted((r.priority, r.stat_date, r.pred) for r in PN.forecast(model, d, future).collect())
    con = duckdb.connect()
    for name, df in (("fut", future.select(*PANEL_KEYS, SR.DATE, *FE.DEPLOYED_FEATURES)), ("daily", d),
                     ("nodes", model.nodes)):
        con.register(name, df.toArrow())
    want = con.sql(REPLAY).fetchall()
    assert len(want) == 35 and [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-12)
    # The rows of the table give what the trees themselves predict.
    own = sorted(rows.filter("priority = '1-URGENT'").collect(), key=lambda r: r.pos)
    x = np.array([[r[c] for c in FE.DEPLOYED_FEATURES] for r in own], float)
    y = np.array([r.y for r in own])
    scored = sorted(PN.score(model, rows.filter("priority = '1-URGENT'")).collect(), key=lambda r: r.pos)
    assert np.allclose(np.log([r.ratio for r in scored]), TR.boosted(x, y, x, 30, 3, 0.1), rtol=1e-9, atol=1e-12)


def test_odd_series(spark):
    rows = spark.createDataFrame([("a", 0, 1.0, 2.0), ("a", 1, 2.0, 4.0), ("a", 2, None, 9.0), ("a", 3, 3.0, None),
                                  ("flat", 0, 1.0, 5.0), ("flat", 1, 2.0, 5.0), (None, 0, 1.0, 7.0), ("none", 0, None, None)],
                                 "s string, pos int, x double, y double")
    model = PN.fit(rows, ["s"], ["x"], "y", 3, 2, 1.0, log_target=False)
    out = {(r.s, r.pos): r.ratio for r in PN.score(model, rows).collect()}
    assert len(out) == 8
    assert [out["a", 0], out["a", 1], out["flat", 0], out["flat", 1]] == pytest.approx([2.0, 4.0, 5.0, 5.0])
    assert out["none", 0] is None
    assert PN.score(PN.fit(rows.limit(0), ["s"], ["x"], "y", 3, 2, 1.0), rows).filter(F.col("ratio").isNotNull()).count() == 0
