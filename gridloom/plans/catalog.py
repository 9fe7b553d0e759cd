"""Query catalog: every registered query is a DataFrame built from the
driver's tables, paired (where SQL can state it) with a DuckDB oracle.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Floating
measures are rounded at the very end (``stable``), and the oracles round the
same columns, so value hashes do not depend on summation order.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


from gridloom.functions.columns import round_half_up as stable_round  # noqa: E402


#: Far below every rounding step, far above the noise of sums of this size.
NOISE_DIGITS = 9


def stable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every DOUBLE column to ``digits`` decimals (comparison edge only).

    The first rounding removes the noise of the summation order, so that a mean
    on an exact tie falls the same way in every engine.
    """
    return df.select(*[stable_round(stable_round(F.col(f"`{f.name}`"), NOISE_DIGITS), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# Importing the query modules fills the registries.
from gridloom.plans import queries_warehouse  # noqa: E402,F401
from gridloom.plans import queries_series  # noqa: E402,F401
from gridloom.plans import queries_models  # noqa: E402,F401
