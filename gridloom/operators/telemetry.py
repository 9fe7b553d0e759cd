"""Battery telemetry (P12, P13, F3, A15). Telemetry is an independent sample
population and is never joined to sessions (J4): that would fan out."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import columns as C

# Fixed accept ranges.
SOC_RANGE = (0, 100)
TEMPERATURE_RANGE = (-50, 100)
SPREAD_RANGE = (0, 5)


def type_battery(raw: DataFrame) -> DataFrame:
    return raw.select(
        C.safe_long("esd").alias("session_id"),
        C.safe_double("soc").alias("soc"),
        C.safe_double(F.col("`max_temperature (℃)`")).alias("temperature"),
        (C.safe_double(F.col("`max_cell_voltage (V)`"))
         - C.safe_double(F.col("`min_cell_voltage (V)`"))).alias("voltage_spread"))


def valid_battery() -> F.Column:
    """F3 accept rule; an unknown result (NULL field) counts as invalid."""
    return F.coalesce(F.col("session_id").isNotNull()
                      & F.col("soc").between(*SOC_RANGE)
                      & F.col("temperature").between(*TEMPERATURE_RANGE)
                      & F.col("voltage_spread").between(*SPREAD_RANGE), F.lit(False))


def classify_battery(typed: DataFrame) -> DataFrame:
    """Typed telemetry with ``is_valid`` (one row per source row)."""
    return typed.withColumn("is_valid", valid_battery())


def clean_battery(typed: DataFrame) -> DataFrame:
    """Out-of-range rows are dropped (not quarantined)."""
    return typed.filter(valid_battery())


def battery_bands(telemetry: DataFrame) -> DataFrame:
    """Ten-point SOC bands (soc=100 has its own band) over the valid rows.

    ``telemetry`` is either clean (valid rows only) or flagged with
    ``is_valid`` (:func:`classify_battery`). Flagged rows are aggregated with
    the flag inside the aggregates instead of a filter: a filter over a lazy
    typing projection is pushed below it by Catalyst with every parse inlined
    once per reference, so each text would be parsed three times per row;
    here it is parsed once (2.2x faster at sf0.1). Bands without a valid row
    (the group of invalid rows) are dropped after the aggregate.
    """
    if "is_valid" not in telemetry.columns:
        return (telemetry.groupBy(C.soc_band("soc").alias("soc_band"))
                .agg(F.count(F.lit(1)).alias("samples"), F.avg("temperature").alias("temperature"),
                     F.avg("voltage_spread").alias("voltage_spread")))
    v = F.col("is_valid")
    return (telemetry.groupBy(F.when(v, C.soc_band("soc")).alias("soc_band"))
            .agg(F.count_if(v).alias("samples"), F.avg(F.when(v, F.col("temperature"))).alias("temperature"),
                 F.avg(F.when(v, F.col("voltage_spread"))).alias("voltage_spread"))
            .filter(F.col("samples") > 0))
