"""Session typing, validation, quarantine, deduplication and enrichment
(P1-P11, F1, F2, F4, F5, J1)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators.joins import join_dimension
from gridloom.session import materialize

RAW_SESSION_COLUMNS = ("sessionId", "kwhTotal", "charging_fees", "chargeTimeHrs", "created", "ended",
                       "stationId", "locationId", "platform", "facilityType", "managerVehicle")

# Fixed accept rule (F1): bounds reject impossible values and infinities.
MAX_AMOUNT = 1e9
MAX_DURATION = 1e6


class KeyConflictError(RuntimeError):
    """The same key carries different rows."""


def type_sessions(raw: DataFrame, century_years: Sequence[str] = C.DEFAULT_CENTURY_YEARS) -> DataFrame:
    """Raw text columns kept for audit, plus typed columns (NULL on failure)."""
    return raw.select(
        "*",
        C.safe_long("sessionId").alias("session_id"),
        C.safe_double("kwhTotal").alias("energy"),
        C.safe_double("charging_fees").alias("fees"),
        C.safe_double("chargeTimeHrs").alias("duration"),
        C.safe_timestamp(C.repair_century("created", century_years)).alias("started"),
        C.safe_timestamp(C.repair_century("ended", century_years)).alias("finished"))


def valid_condition() -> F.Column:
    e, f, d = F.col("energy"), F.col("fees"), F.col("duration")
    return (F.col("session_id").isNotNull() & (e >= 0) & (e < MAX_AMOUNT) & (f >= 0) & (f < MAX_AMOUNT)
            & (d > 0) & (d < MAX_DURATION) & F.col("started").isNotNull()
            & (F.col("finished") >= F.col("started")) & F.col("stationId").isNotNull())


def classify(typed: DataFrame) -> DataFrame:
    """Adds ``is_valid``; an unknown predicate counts as invalid, so accepted
    and rejected always add up to the input."""
    return typed.withColumn("is_valid", F.coalesce(valid_condition(), F.lit(False)))


def accepted(classified: DataFrame) -> DataFrame:
    """Rows with ``is_valid``. Over a lazy classification Catalyst pushes this
    filter below the typing projection and inlines the typed expressions into
    it, so each text is parsed more than once per row; when both outputs are
    needed, write the classification once partitioned by ``is_valid`` (as the
    job does) and filter the read, which prunes partitions instead."""
    return classified.filter("is_valid").drop("is_valid")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(~F.col("is_valid")).drop("is_valid")


def dedup(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact-duplicate removal (NULLs compare equal).

    Typed columns are functions of the raw text, so passing the raw columns as
    ``subset`` gives the same rows with a narrower shuffle key. Spark plans a
    partial (map-side) aggregate first, so a hot duplicated row collapses
    before the shuffle.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def _digest(columns: Sequence[str], seed: int) -> F.Column:
    """64 bits of a row; a null is told from a missing value of the column beside it."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def conflicting_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ, by the least and largest of two digests a row.

    The aggregate has a fixed width, so it is hashed, combined before its one
    shuffle, and no row is moved. Rows that differ are missed with 2^-128.
    """
    agg = df.groupBy(*keys).agg(*[f(_digest(df.columns, i)).alias(f"_{n}{i}")
                                  for i in (1, 2) for n, f in (("lo", F.min), ("hi", F.max))])
    return agg.filter((F.col("_lo1") < F.col("_hi1")) | (F.col("_lo2") < F.col("_hi2"))).select(*keys)


def key_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that carry more than one distinct row: ``keys..., rows``.

    Only rows of conflicting keys are fetched to be counted. The keys are
    written first, so the join knows their bytes and broadcasts a few of them.
    """
    found = materialize(conflicting_keys(df, keys))
    found = found.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    rows = df.join(found, same, "left_semi").dropDuplicates()
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "key") -> None:
    """Guard: raise instead of picking one of several rows for a key.
    ``df`` must already be free of exact duplicates."""
    if df.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise KeyConflictError(f"rows that differ share a {what}")


def dedup_accepted(classified: DataFrame, raw_columns: Sequence[str],
                   century_years: Sequence[str] = C.DEFAULT_CENTURY_YEARS) -> DataFrame:
    """Accepted rows without exact duplicates, typed again after the shuffle.

    Typed columns are functions of the raw text, so deduplicating the raw
    columns alone gives the same rows while the shuffled row stays narrow;
    the re-typing runs after the shuffle, spread over all partitions.

    ``is_valid`` is a function of the raw text as well, so it is carried
    through the aggregation (``bool_or`` of equal values) and the accepted
    rows are kept after it. Filtering first would let Catalyst push the
    predicate below the typing projection and inline every typed expression
    into it once per reference (parsing each text several times per row);
    after the aggregate the predicate is a plain boolean column. Rejected rows
    (a small share) are shuffled too, already collapsed map-side.
    """
    g = classified.groupBy(*raw_columns).agg(F.bool_or("is_valid").alias("_valid"))
    return type_sessions(g.filter("_valid").drop("_valid"), century_years)


def unique_rows_by_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Exact dedup and key-conflict detection in ONE aggregation keyed by ``key``.

    ``min`` and ``max`` of the row struct are computed per key (NULL fields
    compare equal); they are equal iff every row of the key is the same row.
    Partial aggregation collapses exact duplicates before the shuffle, and the
    shuffle key is the narrow ``key``, instead of one shuffle on the whole row
    plus another on the key. Returns ``columns..., _conflict``; where no key
    conflicts, the rows are exactly ``dropDuplicates()`` of the input.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    agg = df.groupBy(key).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
    return agg.select("_lo.*", (~F.col("_lo").eqNullSafe(F.col("_hi"))).alias("_conflict"))


def clean_sessions(raw: DataFrame, century_years: Sequence[str] = C.DEFAULT_CENTURY_YEARS) -> DataFrame:
    """Accepted, exact-deduplicated sessions (raw + typed columns)."""
    return dedup_accepted(classify(type_sessions(raw, century_years)), raw.columns, century_years)


def enrich(clean: DataFrame, stations: DataFrame) -> DataFrame:
    """DWD session table: calendar keys, cleaned dimensions, bands and the
    station label (left join: sessions without metadata are kept). A station
    table too large to broadcast is joined by a shuffle join, where AQE splits
    a skewed (hot) station's partition."""
    st = stations.select(F.col("stationId"), F.col("station_name"))
    joined = join_dimension(clean, st, "stationId", "left")
    s = F.col("started")
    return joined.select(
        "session_id", "energy", "fees", "duration", "started",
        C.month_key(s).alias("month"),
        F.hour(s).alias("hour"),
        C.iso_weekday(s).alias("weekday"),
        C.blank_to_default("platform").alias("platform"),
        C.null_to_default("facilityType").alias("facility"),
        F.col("stationId").alias("station"),
        C.null_to_default("locationId").alias("location"),
        C.null_to_default("managerVehicle").alias("vehicle"),
        C.duration_band("duration").alias("duration_band"),
        C.energy_band("energy").alias("energy_band"),
        C.station_label("station_name", "stationId").alias("station_name"))


def dedup_stations(stations: DataFrame) -> DataFrame:
    """Station metadata without exact duplicates, one row a station.

    Raises when it runs over a station with two different rows, which would
    repeat its sessions in the join.
    """
    rows = unique_rows_by_key(stations, "stationId", stations.columns)
    sound = F.when(F.col("_conflict"), F.raise_error(F.concat(
        F.lit("stations: rows that differ share stationId "), F.col("stationId")))).otherwise(F.col("stationId"))
    return rows.withColumn("stationId", sound).select(*stations.columns)
