"""The warehouse job: raw CSV -> ODS -> DWD -> DWS -> ADS -> snapshot.

Every layer is written to shared storage as a version of its own and the next
layer reads it back, which cuts lineage: a lost executor only recomputes the
stage it was in, and a rerun never shows a reader half a layer. Scale decisions:

* the ODS write materialises every column, so a FAILFAST CSV read surfaces
  structural errors (a pruned ``count`` would miss them);
* classification runs once and is written partitioned by ``is_valid``: the
  quarantine and the accepted rows come from one scan of ODS;
* exact duplicates are removed by one hash aggregate over the raw text, which
  collapses a hot row before the shuffle; what is left of a session ID is one
  row, or a conflict, so the guard counts the IDs of the written rows;
* station metadata is broadcast by its bytes (else shuffle join);
* the twelve rollups are one GROUPING SETS aggregate, materialised once and
  reused for the long table, the per-dimension tables and the JSON document;
* DWD sessions are partitioned by month so later filters prune files.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators import payload as P
from gridloom.operators import quality as Q
from gridloom.operators import rollups as R
from gridloom.operators import series as SR
from gridloom.operators import sessions as S
from gridloom.operators import telemetry as B
from gridloom.sources import raw as RAW
from gridloom.sources import snapshot as SN

SOURCES = ("sessions", "battery", "stations")
WRITE_THREADS = 6


@dataclass
class WarehouseResult:
    root: str
    snapshot_version: int
    counts: dict


def _w(df: DataFrame, root: str, layer: str, name: str, **kw) -> DataFrame:
    RAW.write_layer(df, root, layer, name, **kw)
    return RAW.read_layer(df.sparkSession, root, layer, name)


def build(spark: SparkSession, raw_paths: dict[str, str], root: str,
          century_years=C.DEFAULT_CENTURY_YEARS, partition_sessions_by: str | None = "month",
          snapshot_root: str | None = None) -> WarehouseResult:
    # ODS: source strings kept for audit
    ods = {name: _w(RAW.read_raw(spark, raw_paths[name]), root, "ods", name) for name in SOURCES}

    # DWD: classify once, quarantine and accepted from the same write
    classified = S.classify(S.type_sessions(ods["sessions"], century_years))
    RAW.write_layer(classified, root, "dwd", "classified_sessions", partition_by=["is_valid"])
    # partition values come back as text; the filter on them still prunes files
    cl = RAW.read_layer(spark, root, "dwd", "classified_sessions") \
        .withColumn("is_valid", F.col("is_valid").cast("boolean"))
    rejected = _w(S.rejected(cl), root, "dwd", "rejected_sessions")
    # exact dedup of the narrow raw text, typed again after the shuffle; then the session-ID guard
    raw_cols = list(ods["sessions"].columns)
    unique = S.dedup(S.accepted(cl).select(*raw_cols))
    clean = _w(S.type_sessions(unique, century_years), root, "dwd", "clean_sessions")
    S.require_unique(clean, ["session_id"], "session_id")

    stations = _w(S.dedup(ods["stations"]), root, "dwd", "stations")
    S.require_unique(stations, ["stationId"], "stationId")
    parts = [partition_sessions_by] if partition_sessions_by else None
    dwd = _w(S.enrich(clean, stations), root, "dwd", "sessions", partition_by=parts)
    battery = _w(B.clean_battery(B.type_battery(ods["battery"])), root, "dwd", "battery")

    # DWS: daily series and the shared grouping-sets aggregate
    _w(SR.daily_series(dwd), root, "dws", "daily_series")
    grouped = _w(R.grouped_sets(dwd), root, "dws", "grouped_rollups")
    long = R.long_from_grouped(grouped)
    total = dwd.agg(F.count(F.lit(1)).alias("total"))
    Q.require_reconciled(long, total)
    long = _w(long, root, "dws", "rollups")

    def publish_dimension(name):
        t = _w(R.dimension_from_grouped(grouped, name), root, "dws", name)
        RAW.write_layer(t, root, "ads", name)           # ADS = exact copy of DWS
    # small independent writes: submitted concurrently so they share the executors
    with ThreadPoolExecutor(max_workers=WRITE_THREADS) as pool:
        list(pool.map(publish_dimension, R.DIMENSIONS))
    RAW.write_layer(long, root, "ads", "rollups")

    # ADS document + validated, versioned publication
    quality = Q.quality_counters(cl, dwd, ods, battery)
    quality = _w(quality, root, "ads", "quality")
    gen = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    doc = _w(P.dashboard_document(dwd, battery, quality, gen, grouped), root, "ads", "dashboard")
    RAW.write_document(doc, f"{root.rstrip('/')}/ads/dashboard_json")
    version = SN.publish(doc.select(F.col("doc.generated_at").alias("generated_at"), "payload"),
                         snapshot_root or f"{root.rstrip('/')}/snapshots", "dashboard",
                         checks=P.document_check(doc))
    counts = {r["metric"]: int(r["value"]) for r in quality.collect()}  # a handful of counters
    return WarehouseResult(root, version, counts)


def write_fixture_sources(spark: SparkSession, inputs, base: str) -> dict[str, str]:
    """Write the adapted fixture tables as raw CSV files (BOM on the first
    header, like the source exports) and return their paths."""
    paths = {}
    from gridloom.sources.fixtures import raw_stations
    for name, df in (("sessions", inputs.raw_sessions), ("battery", inputs.raw_battery),
                     ("stations", raw_stations(inputs.table("customer")))):
        paths[name] = f"{base.rstrip('/')}/raw/{name}"
        RAW.write_csv(df, paths[name], bom=True)
    return paths
