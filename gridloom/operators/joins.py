"""Dimension joins."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join whose strategy Spark picks by bytes.

    A dimension below ``spark.sql.autoBroadcastJoinThreshold`` (bytes, by the
    plan's estimate or, with AQE, by the measured shuffle size) is broadcast. A
    larger one is shuffled on ``on``, where AQE splits skewed partitions.
    """
    return fact.join(dim, on, how)


def join_series(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on series keys, where a null key equals a null key; ``other`` brings its columns beside the keys."""
    names = [f"_key{i}" for i in range(len(keys))]
    renamed = other.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                           *[c for c in other.columns if c not in keys])
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return rows.join(renamed, same, how).drop(*names)
