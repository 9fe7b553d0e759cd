"""Level-wise trees against plain recursion, and the comparison over all folds."""
import numpy as np
import pytest

from conftest import SMALL

from gridloom.operators import models as MD
from gridloom.operators import trees as TR
from gridloom.plans import catalog  # noqa: F401  registers the queries in order
from gridloom.plans.queries_series import Series


def plain(x, y, depth):
    """Predictor of a tree by recursion: the first best cut between unlike neighbours."""
    best = None
    if depth != 0 and y.var() > 1e-12:
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, t = x[order, f], y[order]
            for i in range(1, len(v)):
                if v[i] > v[i - 1]:
                    gain = t[:i].sum() ** 2 / i + t[i:].sum() ** 2 / (len(v) - i)
                    if best is None or gain > best[0] + 1e-9 * abs(best[0]):
                        best = gain, f, (v[i] + v[i - 1]) / 2
    if best is None:
        return lambda row: y.mean()
    _, f, cut = best
    left = x[:, f] <= cut
    low, high = (plain(x[s], y[s], None if depth is None else depth - 1) for s in (left, ~left))
    return lambda row: low(row) if row[f] <= cut else high(row)


@pytest.mark.parametrize("depth", [0, 1, 3, None])
def test_tree_equals_recursion(depth):
    rng = np.random.default_rng(4)
    x = np.column_stack([np.arange(200), rng.integers(0, 7, 200), rng.integers(0, 2, 200)]).astype(float)
    y = rng.normal(size=200) + x[:, 1] + (x[:, 0] > 120)
    tree, want = TR.grow(x, y, np.ones((1, 200), int), depth), plain(x, y, depth)
    for row in (x, x + 0.3, rng.uniform(0, 200, (50, 3))):
        assert tree.predict(row) == pytest.approx([want(r) for r in row])
    if depth is None:
        assert tree.predict(x) == pytest.approx(y)


def test_trees_grow_side_by_side():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(80, 2)), rng.normal(size=80)
    weight = np.stack([np.bincount(rng.integers(0, 80, 80), minlength=80) for _ in range(6)])
    alone = [TR.grow(x, y, w[None, :]).predict(x) for w in weight]
    assert TR.grow(x, y, weight).predict(x) == pytest.approx(np.mean(alone, axis=0))
    own = np.repeat(np.arange(80), weight[0])
    assert alone[0] == pytest.approx([plain(x[own], y[own], None)(r) for r in x])
    assert TR.forest(x, y, x, 7, None, 1) == pytest.approx(TR.forest(x, y, x, 7, None, 1))


def test_boosting_equals_a_plain_loop():
    rng = np.random.default_rng(6)
    x, y = rng.integers(0, 9, (60, 3)).astype(float), rng.normal(size=60)
    want = np.full(60, y.mean())
    for _ in range(8):
        tree = plain(x, y - want, 3)
        want = want + 0.1 * np.array([tree(r) for r in x])
    assert TR.boosted(x, y, x, 8, 3, 0.1) == pytest.approx(want)


def test_one_value_and_one_row():
    for y in (np.array([2.0]), np.full(9, 3.0)):
        x = np.arange(len(y), dtype=float)[:, None]
        assert TR.boosted(x, y, x, 3, 3, 0.1) == pytest.approx(y) == TR.forest(x, y, x, 5, None, 0)


def test_comparison_uses_every_fold(spark):
    from pyspark.sql import functions as F

    from gridloom.operators import forecast as FC
    rows = Series(spark, SMALL).rows
    n = rows.count()
    few = [c for c in MD.candidates(gbt={"maxIter": 3}, rf={"numTrees": 3})]
    got = {r.model: r for r in MD.compare(rows, few).collect()}
    assert set(got) == {c.name for c in few}
    assert {r.folds for r in got.values()} == {len(range(110, n - 5 + 1, 21))}
    pdf = [(r.pos, r.total_kwh, r.lag7_kwh) for r in rows.collect()]
    maes = [np.mean([abs(y - p) for pos, y, p in pdf if i <= pos < min(i + 21, n)]) for i in range(110, n - 5 + 1, 21)]
    assert got["naive_lag7"].wf_mae == pytest.approx(np.mean(maes))
    assert got["naive_lag7"].wf_std == pytest.approx(np.std(maes))
    assert got["naive_lag7"].test_mae == pytest.approx(np.mean([abs(y - p) for pos, y, p in pdf if pos >= int(n * 0.8)]))
    # Every fit is that of its rows alone.
    one = MD.fold_predictions(rows, [few[1]]).filter("fold = 4").orderBy("pos").collect()
    names = sorted(few[1].members[0].features)
    frame = sorted((r.pos, r.total_kwh, [float(r[c]) for c in names]) for r in rows.collect())
    x, y = np.array([f[2] for f in frame]), np.array([f[1] for f in frame])
    want = TR.ridge(x[:194], y[:194], x[194:215], MD.RIDGE_ALPHA)
    assert [r.pred for r in one] == pytest.approx(want)
    assert FC.metrics(MD.fold_predictions(rows, [few[2]], walk=False).filter(F.col("fold") == MD.LAST), by=("model",)).count() == 1


def test_a_series_is_fitted_by_itself(spark):
    from pyspark.sql import functions as F
    rows = Series(spark, SMALL).rows
    two = rows.withColumn("s", F.explode(F.array(F.lit("a"), F.lit("b")))).withColumn(
        "total_kwh", F.when(F.col("s") == "b", F.col("total_kwh") * 2).otherwise(F.col("total_kwh")))
    cand = [c for c in MD.candidates() if c.name == "lin_trend"]
    alone = MD.compare(rows, cand).first()
    both = {r.s: r for r in MD.compare(two, cand, keys=["s"]).collect()}
    assert both["a"].wf_mae == pytest.approx(alone.wf_mae) and both["b"].wf_mae == pytest.approx(2 * alone.wf_mae)
