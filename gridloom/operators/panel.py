"""Boosted models of many series as a relational table.

Every series is fitted in a task of its own (a series has a row a day) and
leaves its trees as rows: series, tree, node, feature, cut, left child, value.
The table is saved as a version with its metadata, and it is scored by array
folds: the nodes of a series meet its future rows by a join on the series keys,
and each tree is walked down by as many steps as it has levels. No model is
loaded on the driver, so the number of series is bounded by the tables alone.

Defined results: rows with a null label or feature do not train; a series
without training rows has no nodes, and its ratios and forecast are null; a
series without future rows has no forecast.
"""
from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators import forecast as FC
from gridloom.operators import series as SR
from gridloom.operators import trees as TR
from gridloom.operators.joins import join_series
from gridloom.sources import snapshot as SN

#: The row of a series' mean label; its trees are counted from 0.
BASE = -1
_NODE = "tree int, node int, feature int, cut double, left int, value double"


@dataclass(frozen=True)
class PanelModel:
    """Trees of every series, and what is needed to score them."""
    nodes: DataFrame
    keys: tuple[str, ...]
    features: tuple[str, ...]
    depth: int
    step: float
    log_target: bool

    def save(self, path: str) -> int:
        """The next version: the node table and one metadata row, renamed as a whole."""
        spark = self.nodes.sparkSession
        attempt = SN.attempt_path(path)
        self.nodes.write.parquet(f"{attempt}/nodes")
        meta = {"keys": self.keys, "features": self.features, "depth": self.depth, "step": self.step,
                "log_target": self.log_target}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.json(f"{attempt}/meta")
        SN.mark_complete(spark, attempt)
        return SN.commit(spark, attempt, path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> "PanelModel":
        """A committed version, the latest one if none is named."""
        path = SN.version_path(spark, path, version)
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        return PanelModel(spark.read.parquet(f"{path}/nodes"), tuple(meta["keys"]), tuple(meta["features"]),
                          meta["depth"], meta["step"], meta["log_target"])


def fit(rows: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, rounds: int, depth: int, step: float,
        log_target: bool = True) -> PanelModel:
    """Boosted trees of every series; ``label`` is what they fit, rows are ordered by ``pos``."""
    schema = T.StructType([rows.schema[k] for k in keys] + T._parse_datatype_string(_NODE).fields)
    names = list(keys)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("_pos")
        x = np.stack([group.column(f"_x{i}").to_numpy() for i in range(len(features))], axis=1)
        y = group.column("_y").to_numpy()
        parts = [[np.array([v]) for v in (BASE, 0, -1, 0.0, -1, y.mean())]]
        for tree, t in enumerate(TR.boosting(x, y, rounds, depth, step)):
            n = len(t.value)
            parts.append([np.full(n, tree), np.arange(n), t.feature, t.cut, t.left, t.value])
        columns = [np.concatenate(c) for c in zip(*parts)]
        own = group.select(names).take(pa.array(np.zeros(len(columns[0]), np.int64)))
        for field, values in zip(schema.fields[len(names):], columns):
            kind = pa.float64() if isinstance(field.dataType, T.DoubleType) else pa.int32()
            own = own.append_column(field.name, pa.array(values).cast(kind))
        return own

    ready = rows.select(*keys, F.col("pos").alias("_pos"), F.col(label).cast("double").alias("_y"),
                        *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    ready = ready.dropna(subset=["_y", *[f"_x{i}" for i in range(len(features))]])
    nodes = ready.groupBy(*keys).applyInArrow(run, schema)
    return PanelModel(nodes, tuple(keys), tuple(features), depth, step, log_target)


def score(model: PanelModel, rows: DataFrame, name: str = "ratio") -> DataFrame:
    """All rows with the model output of their series: the ratio, where the target was its logarithm."""
    keys = list(model.keys)
    # A tree is an array of its nodes in order of their number, so a child is found by its place.
    node = F.struct("node", "feature", "cut", "left", "value")
    trees = (model.nodes.groupBy(*keys, "tree").agg(F.sort_array(F.collect_list(node)).alias("_nodes"))
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("tree", "_nodes"))).alias("_trees")))
    x = F.array(*[F.col(f).cast("double") for f in model.features])

    def value(nodes: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            n = nodes[at]
            right = F.col("_x")[F.greatest(n["feature"], F.lit(0))] > n["cut"]
            return F.when(n["feature"] < 0, at).otherwise(n["left"] + right.cast("int"))
        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(model.depth)), F.lit(0), down)
        return nodes[leaf]["value"]

    total = F.aggregate("_trees", F.lit(0.0), lambda s, t: s + value(t["_nodes"]) * F.when(
        t["tree"] == BASE, 1.0).otherwise(float(model.step)))
    scored = join_series(rows.withColumn("_x", x), trees, keys, "left").withColumn("_z", total)
    return scored.withColumn(name, F.exp("_z") if model.log_target else F.col("_z")).drop("_x", "_z", "_trees")


def forecast(model: PanelModel, history: DataFrame, future: DataFrame) -> DataFrame:
    """The recursive forecast of every series from its own trees."""
    ratios = score(model, future).select(*model.keys, SR.DATE, "ratio")
    return FC.recursive_forecast(history, ratios, list(model.keys))
