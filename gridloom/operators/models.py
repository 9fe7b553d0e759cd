"""Model candidates.

The forecasting target is the ratio of a day's energy to its 14-row anchor
(plain or log), so trees learn weekday / holiday effects while the anchor
carries the trend. The comparison fits every (series, learner, fold) in a task
of its own: a row is dealt to the folds that train on it or test it, one shuffle
brings the rows of a fit together (a series has a row a day), and all fits run
side by side. The deployed model is a saved Spark ML pipeline.
"""
from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions import columns as C
from gridloom.operators import features as FE
from gridloom.operators import forecast as FC
from gridloom.operators import series as SR
from gridloom.operators import trees as TR
from gridloom.session import materialize
from gridloom.sources import snapshot as SN

# Fixed hyper-parameters mirroring the candidate definitions.
GBT_PARAMS = dict(maxIter=100, maxDepth=3, stepSize=0.1, seed=42, subsamplingRate=1.0)
#: Without a depth, trees grow until their leaves hold one value.
RF_PARAMS = dict(numTrees=400, maxDepth=None, seed=42)
RIDGE_ALPHA = 1.0
SEED = 42


@dataclass(frozen=True)
class Target:
    """What a learner is fitted on, and how its output ``_z`` becomes energy again."""
    label: Callable[[], Column]
    energy: Callable[[], Column]


TARGETS = {
    "raw": Target(lambda: F.col(SR.TARGET), lambda: F.col("_z")),
    "ratio": Target(lambda: F.try_divide(F.col(SR.TARGET), F.col(FE.ANCHOR)),
                    lambda: C.ratio_inverse("_z", FE.ANCHOR, False)),
    "logratio": Target(lambda: C.log_ratio(SR.TARGET, FE.ANCHOR),
                       lambda: C.ratio_inverse("_z", FE.ANCHOR, True)),
}


@dataclass(frozen=True)
class Member:
    """One fitted part of a candidate."""
    target: str
    learner: str                 # gbt | rf | ridge
    features: tuple[str, ...]
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Candidate:
    """The mean of its members' energies, or a column taken as it is."""
    name: str
    members: tuple[Member, ...] = ()
    column: str | None = None


def candidates(gbt: dict | None = None, rf: dict | None = None) -> list[Candidate]:
    """The fixed candidate list."""
    g = {**GBT_PARAMS, **(gbt or {})}
    r = {**RF_PARAMS, **(rf or {})}
    trend = Member("raw", "ridge", tuple(FE.F_LIN))
    ratio = Member("ratio", "gbt", tuple(FE.F_CAL_T), g)
    return [
        Candidate("naive_lag7", column="lag7_kwh"),
        Candidate("lin_trend", (trend,)),
        Candidate("gbr_ratio14", (ratio,)),
        Candidate("gbr_ratio14_cal", (Member("ratio", "gbt", tuple(FE.F_CAL), g),)),
        Candidate("gbr_logratio14", (Member("logratio", "gbt", tuple(FE.F_CAL_T), g),)),
        Candidate("rf_ratio14", (Member("ratio", "rf", tuple(FE.F_CAL_T), r),)),
        Candidate("ens_ratio14_lin", (ratio, trend)),
    ]


def _split_points(train: DataFrame, feats: Sequence[str]) -> int:
    """Bins that leave every distinct value a split of its own: a feature has one value a day at most."""
    row = train.agg(*[F.count_distinct(x).alias(x) for x in feats]).first()
    return max(2, *row)


def _estimator(learner: str, params: dict, feats: Sequence[str], label: str, train: DataFrame):
    if learner == "gbt":
        return GBTRegressor(featuresCol="_x", labelCol=label, predictionCol="_z", lossType="squared",
                            **{"maxBins": _split_points(train, feats), **params})
    if learner == "ridge":
        # sklearn's Ridge(alpha) equals Spark's normal-equation solver with the
        # penalty rescaled: Spark scales the label by its std inside the fit.
        st = train.agg(F.stddev_pop(label).alias("s"), F.count(F.lit(1)).alias("n")).first()
        reg = RIDGE_ALPHA * float(st["s"] or 0.0) / max(int(st["n"]), 1)
        return LinearRegression(featuresCol="_x", labelCol=label, predictionCol="_z", regParam=reg,
                                elasticNetParam=0.0, standardization=False, solver="normal", fitIntercept=True)
    raise ValueError(learner)


def fit(learner: str, params: dict, feats: Sequence[str], train: DataFrame, label: str) -> PipelineModel:
    t = train.filter(F.col(label).isNotNull())
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(feats), outputCol="_x"),
                            _estimator(learner, params, feats, label, t)])
    return pipe.fit(t)


#: The fold that stands for the final split.
LAST = -1


def _fit_task(members: Sequence[Member], names: Sequence[str], kept: Sequence[str]):
    """Fits one member on the training rows of a group and predicts its label for the test rows."""
    def run(group: pa.Table) -> pa.Table:
        member = members[group.column("member")[0].as_py()]
        at = [names.index(f) for f in member.features]
        x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)[:, at]
        y = group.column(f"label_{member.target}").to_numpy(zero_copy_only=False).astype(float)
        is_test = group.column("is_test").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(group.column("pos").to_numpy(), kind="stable")
        train = order[~is_test[order] & ~np.isnan(y[order])]
        test = np.flatnonzero(is_test)
        p, fitted = member.params, (x[train], y[train], x[test])
        if not len(train) or not len(test):
            z = np.full(len(test), np.nan)
        elif member.learner == "ridge":
            z = TR.ridge(*fitted, RIDGE_ALPHA)
        elif member.learner == "gbt":
            z = TR.boosted(*fitted, p["maxIter"], p["maxDepth"], p["stepSize"])
        elif member.learner == "rf":
            z = TR.forest(*fitted, p["numTrees"], p["maxDepth"], p["seed"])
        else:
            raise ValueError(member.learner)
        return group.select(list(kept)).take(pa.array(test)).append_column("_z", pa.array(z, pa.float64()))
    return run


def in_folds(rows: DataFrame, keys: Sequence[str] = (), start: int = SR.WF_START, step: int = SR.WF_STEP,
             horizon: int = SR.WF_HORIZON, min_test: int = SR.WF_MIN_TEST, walk: bool = True) -> DataFrame:
    """A row for every fold that trains on it or tests it, with ``fold`` and ``is_test``; LAST is the 80/20 split."""
    n = F.max("pos").over(Window.partitionBy(*keys)) + 1
    later = F.floor((F.col("pos") - start - horizon) / step) + 1
    first, last = F.greatest(F.lit(0), later), F.floor((F.col("_n") - min_test - start) / step)
    every = F.when(F.lit(walk) & (first <= last), F.sequence(first.cast("int"), last.cast("int"))).otherwise(
        F.array().cast("array<int>"))
    dealt = rows.withColumn("_n", n).withColumn("fold", F.explode(F.concat(F.array(F.lit(LAST)), every)))
    train_end = F.when(F.col("fold") == LAST, F.floor(F.col("_n") * SR.TRAIN_FRACTION)).otherwise(
        F.lit(start) + F.col("fold") * step)
    return dealt.withColumn("is_test", F.col("pos") >= train_end).drop("_n")


def fold_predictions(rows: DataFrame, cands: Sequence[Candidate], keys: Sequence[str] = (), **folds) -> DataFrame:
    """keys, model, fold, stat_date, pos, energy and ``pred`` of every test row of every fold and candidate."""
    members: list[Member] = []
    for c in cands:
        members += [m for m in c.members if m not in members]
    names = sorted({f for m in members for f in m.features})
    kept = [*keys, "member", "fold", SR.DATE, "pos", SR.TARGET, FE.ANCHOR]
    dealt = in_folds(rows, keys, **folds)
    out = []
    for c in cands:
        if c.column:
            out.append(dealt.filter("is_test").select(*keys, F.lit(c.name).alias("model"), "fold", SR.DATE, "pos",
                                                      SR.TARGET, F.col(c.column).alias("pred")))
    if members:
        labels = [TARGETS[t].label().cast("double").alias(f"label_{t}") for t in sorted({m.target for m in members})]
        ready = dealt.select(*[c for c in kept if c != "member"], "is_test", *labels,
                             F.array(*[F.col(f).cast("double") for f in names]).alias("x"),
                             F.explode(F.array(*[F.lit(i) for i in range(len(members))])).alias("member"))
        schema = ready.select(*kept).withColumn("_z", F.lit(0.0)).schema
        # A fit is little data and much work, so its partitions are not merged by their bytes.
        conf = rows.sparkSession.conf
        tasks = max(int(conf.get("spark.sql.shuffle.partitions")), 4 * rows.sparkSession.sparkContext.defaultParallelism)
        ready = ready.repartition(tasks, *keys, "member", "fold")
        fitted = ready.groupBy(*keys, "member", "fold").applyInArrow(_fit_task(members, names, kept), schema)
        energy, used = F.lit(None).cast("double"), F.lit(None).cast("array<string>")
        for i, m in enumerate(members):
            energy = F.when(F.col("member") == i, TARGETS[m.target].energy()).otherwise(energy)
            used = F.when(F.col("member") == i, F.array(*[F.lit(c.name) for c in cands if m in c.members])).otherwise(used)
        each = fitted.withColumn("_energy", energy).withColumn("model", F.explode(used))
        out.append(each.groupBy(*keys, "model", "fold", SR.DATE, "pos", SR.TARGET).agg(F.avg("_energy").alias("pred")))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def compare(rows: DataFrame, cands: Sequence[Candidate], keys: Sequence[str] = (), **folds) -> DataFrame:
    """Walk-forward fold MAE (mean, population std, count) over all folds and the final
    80/20 test MAE/RMSE/sMAPE for every candidate. ``rows`` carries ``pos``."""
    found = FC.metrics(fold_predictions(materialize(rows), cands, keys, **folds), by=(*keys, "model", "fold"))
    found = materialize(found)
    walked = FC.fold_summary(found.filter(F.col("fold") != LAST), by=(*keys, "model"))
    last = found.filter(F.col("fold") == LAST).select(*keys, "model", F.col("mae").alias("test_mae"),
                                                      F.col("rmse").alias("test_rmse"), F.col("smape").alias("test_smape"))
    return walked.join(last, [*keys, "model"])


def final_metrics(rows: DataFrame, cand: Candidate, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and sMAPE of one candidate on the final split."""
    return FC.metrics(fold_predictions(rows, [cand], keys, walk=False), by=(*keys, "model"))


# ------------------------------------------------------------------ deployed model
@dataclass
class Bundle:
    model: PipelineModel
    features: list[str]
    target: str
    anchor: str
    log_target: bool
    t_max: int

    def save(self, spark, path: str) -> int:
        """The next version of the bundle: model directory plus one metadata row (features, target, anchor, t_max).

        Both are written to an attempt folder that is renamed as a whole, so a save that fails leaves the versions
        before it as they are, and no reader or second writer meets a mixture.
        """
        attempt = SN.attempt_path(path)
        self.model.write().save(f"{attempt}/model")
        meta = {"features": self.features, "target": self.target, "anchor": self.anchor,
                "log_target": self.log_target, "t_max": self.t_max}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.json(f"{attempt}/meta")
        SN.mark_complete(spark, attempt)
        return SN.commit(spark, attempt, path)

    @staticmethod
    def load(spark, path: str, version: int | None = None) -> "Bundle":
        """A committed version, the latest one if none is named."""
        path = SN.version_path(spark, path, version)
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        return Bundle(PipelineModel.load(f"{path}/model"), meta["features"], meta["target"], meta["anchor"],
                      meta["log_target"], int(meta["t_max"]))


def train_deployed(rows: DataFrame, params: dict | None = None) -> tuple[DataFrame, Bundle]:
    """M1: fit the log-ratio GBT on the first 80 %, report test metrics (model and
    the 14-row-mean baseline), then refit on all rows (M11)."""
    p = {**GBT_PARAMS, **(params or {})}
    rows = materialize(rows)
    labeled = rows.withColumn("_y", C.log_ratio(SR.TARGET, FE.ANCHOR))
    st = rows.agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("t_max")).first()
    cut = int(st["n"] * SR.TRAIN_FRACTION)
    tr, te = labeled.filter(F.col("pos") < cut), labeled.filter(F.col("pos") >= cut)
    # the evaluation fit and the deployment refit are independent: run them concurrently
    with ThreadPoolExecutor(max_workers=2) as pool:
        split_fit = pool.submit(fit, "gbt", p, FE.DEPLOYED_FEATURES, tr, "_y")
        full_fit = pool.submit(fit, "gbt", p, FE.DEPLOYED_FEATURES, labeled, "_y")
        m, full = split_fit.result(), full_fit.result()
    pred = m.transform(te).select(SR.DATE, SR.TARGET, FE.ANCHOR,
                                  C.ratio_inverse("_z", FE.ANCHOR, True).alias("pred"))
    both = pred.select(F.lit("gbr_logratio14").alias("model"), SR.TARGET, "pred").unionByName(
        pred.select(F.lit("naive_anchor14").alias("model"), SR.TARGET, F.col(FE.ANCHOR).alias("pred")))
    report = FC.metrics(both)
    return report, Bundle(full, list(FE.DEPLOYED_FEATURES), SR.TARGET, FE.ANCHOR, True, int(st["t_max"]))


def forecast_with(bundle: Bundle, history: DataFrame, future: DataFrame) -> DataFrame:
    """W6 with a trained model: ratios for all future days from one transform,
    then the recursive anchor fold. ``future`` comes from ``future_frame``."""
    z = bundle.model.transform(future)
    ratio = F.exp(F.col("_z")) if bundle.log_target else F.col("_z")
    ratios = z.select(SR.DATE, ratio.alias("ratio"))
    return FC.recursive_forecast(history, ratios)
