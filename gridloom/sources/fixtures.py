"""Adapters that give the driver's tables the shape of the warehouse inputs.

The rules are deterministic and documented in FIXTURES.md §2; the DuckDB
oracles in :mod:`gridloom.plans.oracles` express the very same rules in SQL.
Each adapter is a single narrow projection over one scan, so Catalyst prunes
columns at the Parquet reader and nothing shuffles.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.calendar import calendar_for

# Fixed values of the adapters (FIXTURES.md §2).
FIXTURE_CENTURY_YEARS = ("24",)      # `0024-` is repaired to `2024-`
BAD_ID_MOD, NEG_ENERGY_MOD, NAN_ENERGY_MOD = 101, 89, 211
ZERO_DURATION_MOD, CENTURY_KEEP_MOD, REVERSED_END_MOD = 131, 3, 79
NO_STATION_MOD, NO_LOCATION_MOD, BLANK_PLATFORM_MOD = 97, 61, 83
DUPLICATE_MOD, LOCATION_COUNT, STATION_GAP_MOD = 50, 25, 10
SECONDS_PER_K, HOURS_PER_K_DIVISOR = 288, 12.5
# Fixed-date holidays, and dates that are worked when they fall on a weekend.
HOLIDAYS = ((1, 1, "New Year's Day"), (5, 1, "Labour Day"), (10, 1, "National Day"))
MAKEUP_WORKDAYS = ((5, 4), (10, 7))


def work_calendar(series: DataFrame) -> DataFrame:
    """The fixture calendar over the days of a series and its forecast horizon."""
    return calendar_for(series, HOLIDAYS, MAKEUP_WORKDAYS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c) -> F.Column:
    return c.cast("string")


def raw_sessions(events: DataFrame) -> DataFrame:
    """events -> raw session rows, every column text, with planted defects.

    Duplicates are produced by exploding one or two copies per row, so the
    events table is scanned once.
    """
    e, k, ts_text = F.col("event_id"), F.col("_k"), F.col("_ts_text")
    ended_ts = F.when(e % REVERSED_END_MOD == 0, F.timestamp_add("HOUR", F.lit(-1), F.col("ts"))) \
        .otherwise(F.timestamp_add("SECOND", (k + 1) * SECONDS_PER_K, F.col("ts")))
    copies = F.when(e % DUPLICATE_MOD == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    # The JSON field and the timestamp text are used several times: they are
    # computed once in an inner projection (Catalyst does not inline an
    # expensive expression that is referenced more than once).
    return (events
            .select("event_id", "ts", "user_id", "event_type", "value",
                    F.get_json_object("props", "$.k").cast("bigint").alias("_k"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("_ts_text"))
            .select(
                F.when(e % BAD_ID_MOD == 0, F.concat(F.lit("x"), _text(e))).otherwise(_text(e)).alias("sessionId"),
                F.when(e % NEG_ENERGY_MOD == 0, F.lit("-1.5"))
                 .when(e % NAN_ENERGY_MOD == 0, F.lit("NaN"))
                 .otherwise(_text(F.col("value"))).alias("kwhTotal"),
                F.format_string("%.4f", F.round(F.col("value") * 0.02, 4)).alias("charging_fees"),
                F.when(e % ZERO_DURATION_MOD == 0, F.lit("0"))
                 .otherwise(_text((k + 1) / F.lit(HOURS_PER_K_DIVISOR))).alias("chargeTimeHrs"),
                F.when(e % CENTURY_KEEP_MOD == 0, ts_text)
                 .otherwise(F.concat(F.lit("00"), F.substring(ts_text, 3, 100))).alias("created"),
                F.date_format(ended_ts, "yyyy-MM-dd HH:mm:ss").alias("ended"),
                F.when(e % NO_STATION_MOD == 0, F.lit(None).cast("string"))
                 .when(F.col("user_id") % STATION_GAP_MOD == 0, F.concat(F.lit("u"), _text(F.col("user_id"))))
                 .otherwise(_text(F.col("user_id"))).alias("stationId"),
                F.when(e % NO_LOCATION_MOD == 0, F.lit(None).cast("string"))
                 .otherwise(_text(F.col("user_id") % LOCATION_COUNT)).alias("locationId"),
                F.when(e % BLANK_PLATFORM_MOD == 0, F.lit("  ")).otherwise(F.col("event_type")).alias("platform"),
                _text(k % 4 + 1).alias("facilityType"),
                _text(k % 2).alias("managerVehicle"),
                F.explode(copies).alias("_copy"))
            .drop("_copy"))


def raw_stations(customer: DataFrame) -> DataFrame:
    """customer -> station metadata (text), every row of it."""
    return customer.select(_text(F.col("c_custkey")).alias("stationId"), F.col("c_name").alias("station_name"))


# Raw battery header names as exported by the telemetry source.
BATTERY_COLUMNS = ("esd", "soc", "max_temperature (℃)", "max_cell_voltage (V)", "min_cell_voltage (V)")


def raw_battery(lineitem: DataFrame) -> DataFrame:
    """lineitem -> raw battery telemetry (text columns with unicode names)."""
    esd, soc, temp, vmax, vmin = BATTERY_COLUMNS
    return lineitem.select(
        _text(F.col("l_orderkey")).alias(esd),
        _text(F.col("l_quantity") * 2).alias(soc),
        _text(F.col("l_tax") * 1500).alias(temp),
        _text(F.col("l_discount")).alias(vmax),
        _text(F.col("l_tax")).alias(vmin))


def order_sessions(orders: DataFrame) -> DataFrame:
    """orders -> accepted-session shaped rows for the daily load series.

    energy = o_totalprice, fees = 2 % of it, station = o_custkey; the order
    priority serves as a series key for panel (many-series) forecasting.
    """
    return orders.select(
        F.col("o_orderkey").alias("session_id"),
        F.col("o_orderdate").alias("started"),
        F.col("o_totalprice").alias("energy"),
        (F.col("o_totalprice") * 0.02).alias("fees"),
        _text(F.col("o_custkey")).alias("station"),
        F.col("o_orderpriority").alias("priority"))
