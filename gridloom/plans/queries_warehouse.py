"""Warehouse queries: scans, typing, quality, joins, rollups, marts."""
from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators import marts as M
from gridloom.operators import quality as Q
from gridloom.operators import rollups as R
from gridloom.operators import sessions as S
from gridloom.operators import telemetry as B
from gridloom.plans import oracle_sql as O
from gridloom.plans.catalog import register, stable
from gridloom.plans.inputs import Inputs
from gridloom.session import materialize, scratch_path
from gridloom.sources import raw as RAW

MEAS = list(O.MEASURE_COLS)


def _w(spark, sf_dir) -> Inputs:
    return Inputs(spark, sf_dir)


# ---------------------------------------------------------------- scans
@register("csv_scan", O.with_ctes(O.RAW_SESSIONS, "SELECT * FROM raw_sessions"))
def csv_scan(spark, sf_dir):
    """Raw sessions written as header CSV (BOM on the first header) to the
    shared folder, then read back as all-text columns matched by name."""
    path = scratch_path(spark, "raw-sessions-csv")
    RAW.write_csv(_w(spark, sf_dir).raw_sessions, path, bom=True)
    return RAW.read_raw(spark, path)


@register("header_clean", O.with_ctes(O.BATTERY, """
SELECT esd, soc, "max_temperature (℃)", "max_cell_voltage (V)", "min_cell_voltage (V)" FROM raw_battery"""))
def header_clean(spark, sf_dir):
    path = scratch_path(spark, "raw-battery-csv")
    RAW.write_csv(_w(spark, sf_dir).raw_battery, path, bom=True)
    df = RAW.read_raw(spark, path)
    return df.select("esd", "soc", F.col("`max_temperature (℃)`"), F.col("`max_cell_voltage (V)`"),
                     F.col("`min_cell_voltage (V)`"))


# ---------------------------------------------------------------- projections
@register("safe_cast", O.rounded(O.with_ctes(O.TYPED, """
SELECT "sessionId", "kwhTotal", session_id, energy, fees, duration FROM typed"""), ["energy", "fees", "duration"]))
def safe_cast(spark, sf_dir):
    return stable(_w(spark, sf_dir).typed.select("sessionId", "kwhTotal", "session_id", "energy", "fees", "duration"))


@register("century_repair", O.with_ctes(O.RAW_SESSIONS, """
SELECT created, regexp_replace(created, '^00(24)-', '20\\1-') AS repaired,
       ended, regexp_replace(ended, '^00(24)-', '20\\1-') AS ended_repaired FROM raw_sessions"""))
def century_repair(spark, sf_dir):
    r = _w(spark, sf_dir).raw_sessions
    from gridloom.sources.fixtures import FIXTURE_CENTURY_YEARS as Y
    return r.select("created", C.repair_century("created", Y).alias("repaired"),
                    "ended", C.repair_century("ended", Y).alias("ended_repaired"))


@register("safe_timestamp", O.with_ctes(O.TYPED, "SELECT created, ended, started, finished FROM typed"))
def safe_timestamp(spark, sf_dir):
    return _w(spark, sf_dir).typed.select("created", "ended", "started", "finished")


@register("clean_text", O.with_ctes(O.RAW_SESSIONS, """
SELECT platform AS platform_raw, coalesce(nullif(trim(platform), ''), 'unknown') AS platform,
       coalesce("facilityType", 'unknown') AS facility, coalesce("locationId", 'unknown') AS location,
       coalesce("managerVehicle", 'unknown') AS vehicle FROM raw_sessions"""))
def clean_text(spark, sf_dir):
    r = _w(spark, sf_dir).raw_sessions
    return r.select(F.col("platform").alias("platform_raw"), C.blank_to_default("platform").alias("platform"),
                    C.null_to_default("facilityType").alias("facility"),
                    C.null_to_default("locationId").alias("location"),
                    C.null_to_default("managerVehicle").alias("vehicle"))


_BAND_ORDER_SQL = {
    "duration_band": "CASE duration_band WHEN '<1h' THEN 1 WHEN '1–3h' THEN 2 WHEN '3–6h' THEN 3 WHEN '≥6h' THEN 4 END",
    "energy_band": "CASE energy_band WHEN '<5kWh' THEN 1 WHEN '5–10kWh' THEN 2 WHEN '10–20kWh' THEN 3 WHEN '≥20kWh' THEN 4 END",
}


@register("band_duration", O.rounded(O.with_ctes(O.DWD, f"""
SELECT session_id, duration, duration_band, CAST({_BAND_ORDER_SQL['duration_band']} AS INTEGER) AS band_order
FROM dwd"""), ["duration"]))
def band_duration(spark, sf_dir):
    d = _w(spark, sf_dir).dwd
    return stable(d.select("session_id", "duration", "duration_band",
                           C.band_order("duration_band", C.DURATION_LABELS).alias("band_order")))


@register("band_energy", O.rounded(O.with_ctes(O.DWD, f"""
SELECT session_id, energy, energy_band, CAST({_BAND_ORDER_SQL['energy_band']} AS INTEGER) AS band_order
FROM dwd"""), ["energy"]))
def band_energy(spark, sf_dir):
    d = _w(spark, sf_dir).dwd
    return stable(d.select("session_id", "energy", "energy_band",
                           C.band_order("energy_band", C.ENERGY_LABELS).alias("band_order")))


@register("station_label", O.with_ctes(O.DWD, "SELECT DISTINCT station, station_name FROM dwd"))
def station_label(spark, sf_dir):
    return _w(spark, sf_dir).dwd.select("station", "station_name").distinct()


# ---------------------------------------------------------------- filters
_TYPED_COLS = ["session_id", "energy", "fees", "duration", "started", "finished"]


@register("sessions_accepted", O.rounded(O.with_ctes(O.TYPED, """
SELECT "stationId", session_id, energy, fees, duration, started, finished FROM classified WHERE is_valid"""),
    ["energy", "fees", "duration"]))
def sessions_accepted(spark, sf_dir):
    return stable(_w(spark, sf_dir).accepted_rows.select("stationId", *_TYPED_COLS))


@register("sessions_rejected", O.rounded(O.with_ctes(O.TYPED, """
SELECT "sessionId", "kwhTotal", "chargeTimeHrs", created, ended, "stationId",
       session_id, energy, fees, duration, started, finished FROM classified WHERE NOT is_valid"""),
    ["energy", "fees", "duration"]))
def sessions_rejected(spark, sf_dir):
    rj = S.rejected(_w(spark, sf_dir).classified)
    return stable(rj.select("sessionId", "kwhTotal", "chargeTimeHrs", "created", "ended", "stationId", *_TYPED_COLS))


@register("dedup_exact", O.rounded(O.with_ctes(O.TYPED, """
SELECT "sessionId", "stationId", platform, session_id, energy, fees, duration, started, finished FROM clean"""),
    ["energy", "fees", "duration"]))
def dedup_exact(spark, sf_dir):
    return stable(_w(spark, sf_dir).clean.select("sessionId", "stationId", "platform", *_TYPED_COLS))


@register("key_conflicts", """
SELECT l_orderkey, l_linenumber, count(*) AS "rows"
FROM (SELECT DISTINCT * FROM lineitem) AS d
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def key_conflicts(spark, sf_dir):
    li = _w(spark, sf_dir).table("lineitem")
    return S.key_conflicts(li, ["l_orderkey", "l_linenumber"])


@register("battery_clean", O.rounded(O.with_ctes(O.BATTERY, "SELECT * FROM battery"),
                                     ["soc", "temperature", "voltage_spread"]))
def battery_clean(spark, sf_dir):
    return stable(_w(spark, sf_dir).battery)


@register("nonfinite_check", O.with_ctes(O.TYPED, """
SELECT 'energy' AS "column", count(*) FILTER (WHERE isnan(energy) OR isinf(energy)) AS nonfinite FROM typed
UNION ALL SELECT 'fees', count(*) FILTER (WHERE isnan(fees) OR isinf(fees)) FROM typed
UNION ALL SELECT 'duration', count(*) FILTER (WHERE isnan(duration) OR isinf(duration)) FROM typed"""))
def nonfinite_check(spark, sf_dir):
    return Q.nonfinite_counts(_w(spark, sf_dir).typed, ["energy", "fees", "duration"])


@register("quality_counters", O.with_ctes(O.DWD + "," + O.BATTERY, """
SELECT 'rejected_sessions' AS metric, count(*) AS value FROM classified WHERE NOT is_valid
UNION ALL SELECT 'accepted_sessions', count(*) FROM dwd
UNION ALL SELECT 'battery_accepted', count(*) FROM battery
UNION ALL SELECT 'source_rows.sessions', count(*) FROM raw_sessions
UNION ALL SELECT 'source_rows.battery', count(*) FROM raw_battery
UNION ALL SELECT 'source_rows.stations', count(*) FROM stations
UNION ALL SELECT 'duplicates_removed',
  (SELECT count(*) FROM raw_sessions) - (SELECT count(*) FROM dwd) - (SELECT count(*) FROM classified WHERE NOT is_valid)
"""))
def quality_counters(spark, sf_dir):
    w = _w(spark, sf_dir)
    return Q.quality_counters(w.classified, w.dwd, {"stations": w.raw_stations},
                              battery_classified=w.battery_flagged)


# ---------------------------------------------------------------- join
@register("sessions_enriched", O.rounded(O.with_ctes(O.DWD, "SELECT * FROM dwd"), ["energy", "fees", "duration"]))
def sessions_enriched(spark, sf_dir):
    return stable(_w(spark, sf_dir).dwd)


# ---------------------------------------------------------------- rollups
def _rollup_query(name):
    keys = R.DIMENSIONS[name]

    def q(spark, sf_dir):
        return stable(R.order_rollup(R.rollup(_w(spark, sf_dir).dwd, keys), name))
    q.__name__ = f"rollup_{name}"
    return q


for _name, _keys in O.DIMS:
    register(f"rollup_{_name}", O.rollup_sql(_keys))(_rollup_query(_name))

_LONG_SQL = O.rounded(O.with_ctes(O.DWD, O.long_rollup_body()), MEAS)


@register("rollup_all", _LONG_SQL)
def rollup_all(spark, sf_dir):
    return stable(R.rollup_all(_w(spark, sf_dir).dwd))


@register("overview", O.rounded(O.with_ctes(O.DWD, """
SELECT count(*) AS sessions, sum(energy) AS energy, sum(fees) AS fees, count(DISTINCT station) AS stations,
       avg(duration) AS avg_duration FROM dwd"""), ["energy", "fees", "avg_duration"]))
def overview(spark, sf_dir):
    return stable(R.overview(_w(spark, sf_dir).dwd))


@register("battery_bands", O.rounded(O.with_ctes(O.BATTERY, """
SELECT CAST(floor(soc / 10) * 10 AS BIGINT) AS soc_band, count(*) AS samples, avg(temperature) AS temperature,
       avg(voltage_spread) AS voltage_spread FROM battery GROUP BY 1"""), ["temperature", "voltage_spread"]))
def battery_bands(spark, sf_dir):
    return stable(B.battery_bands(_w(spark, sf_dir).battery_flagged))


# ---------------------------------------------------------------- quality over rollups
_TOTAL_CTE = ", total AS (SELECT count(*) AS total FROM dwd), longr AS (" + O.long_rollup_body() + ")"


@register("reconcile_dimensions", O.with_ctes(O.DWD + _TOTAL_CTE, """
SELECT l.dimension, CAST(sum(l.sessions) AS BIGINT) AS sessions, max(t.total) AS total,
       CAST(sum(l.sessions) AS BIGINT) = max(t.total) AS reconciled
FROM longr l, total t GROUP BY l.dimension"""))
def reconcile_dimensions(spark, sf_dir):
    d = _w(spark, sf_dir).dwd
    total = d.agg(F.count(F.lit(1)).alias("total"))
    per = Q.dimension_totals(R.rollup_all(d)).withColumn("_k", F.lit(1))
    return (per.join(F.broadcast(total.withColumn("_k", F.lit(1))), "_k").drop("_k")
            .withColumn("reconciled", F.col("sessions") == F.col("total")))


@register("snapshot_check", O.with_ctes(O.DWD + _TOTAL_CTE, """
SELECT max(t.total) AS total, count(*) AS dimensions,
       count(*) FILTER (WHERE s.sessions <> t.total) AS unreconciled,
       max(t.total) > 0 AND count(*) >= 12 AND count(*) FILTER (WHERE s.sessions <> t.total) = 0 AS ok,
       CAST(NULL AS VARCHAR) AS reason
FROM (SELECT dimension, CAST(sum(sessions) AS BIGINT) AS sessions FROM longr GROUP BY dimension) s, total t"""))
def snapshot_check(spark, sf_dir):
    d = _w(spark, sf_dir).dwd
    return Q.snapshot_check(R.rollup_all(d), d.agg(F.count(F.lit(1)).alias("total")))


@register("analysis_lookup", O.rounded(O.with_ctes(O.DWD + _TOTAL_CTE, """
SELECT * FROM longr WHERE dimension = 'platform_facility'"""), MEAS))
def analysis_lookup(spark, sf_dir):
    return stable(R.analyse(_w(spark, sf_dir).dwd, "platform_facility"))


# ---------------------------------------------------------------- marts
@register("band_order", O.with_ctes(O.DWD, f"""
SELECT 'duration' AS dimension, duration_band AS band, CAST({_BAND_ORDER_SQL['duration_band']} AS INTEGER) AS band_order,
       count(*) AS sessions FROM dwd GROUP BY duration_band
UNION ALL
SELECT 'energy', energy_band, CAST({_BAND_ORDER_SQL['energy_band']} AS INTEGER), count(*) FROM dwd GROUP BY energy_band"""))
def band_order(spark, sf_dir):
    d = _w(spark, sf_dir).dwd
    parts = []
    for name, labels in R.BAND_LABELS.items():
        key = R.DIMENSIONS[name][0]
        r = R.rollup(d, [key])
        parts.append(r.select(F.lit(name).alias("dimension"), F.col(key).alias("band"),
                              C.band_order(key, labels).alias("band_order"), "sessions"))
    return parts[0].unionByName(parts[1])


def _top_sql(metric):
    return O.rounded(O.with_ctes(O.DWD, f"""
SELECT CAST(row_number() OVER (ORDER BY {metric} DESC, station ASC) AS INTEGER) AS rank, station, {metric}
FROM (SELECT station, {O.MEASURES} FROM dwd GROUP BY station) r
ORDER BY {metric} DESC, station ASC LIMIT 10"""), ["energy"] if metric == "energy" else [])


@register("top_stations_energy", _top_sql("energy"))
def top_stations_energy(spark, sf_dir):
    return stable(M.top_n(R.dimension_rollup(_w(spark, sf_dir).dwd, "station"), "station", "energy"))


@register("top_stations_sessions", _top_sql("sessions"))
def top_stations_sessions(spark, sf_dir):
    return stable(M.top_n(R.dimension_rollup(_w(spark, sf_dir).dwd, "station"), "station", "sessions"))


def _share_sql(key):
    return O.rounded(O.with_ctes(O.DWD, f"""
SELECT {key}, value, value / sum(value) OVER () AS share
FROM (SELECT {key}, sum(energy) AS value FROM dwd GROUP BY {key}) r"""), ["value", "share"], 6)


for _dim in ("platform", "facility", "vehicle"):
    def _mk(dim):
        def q(spark, sf_dir):
            return stable(M.share(R.dimension_rollup(_w(spark, sf_dir).dwd, dim), dim, "energy"), 6)
        return q
    register(f"share_{_dim}", _share_sql(_dim))(_mk(_dim))


@register("pivot_platform_facility", O.rounded(O.with_ctes(O.DWD, """
SELECT platform,
  coalesce(sum(energy) FILTER (WHERE facility = '1'), 0) AS "1",
  coalesce(sum(energy) FILTER (WHERE facility = '2'), 0) AS "2",
  coalesce(sum(energy) FILTER (WHERE facility = '3'), 0) AS "3",
  coalesce(sum(energy) FILTER (WHERE facility = '4'), 0) AS "4"
FROM dwd GROUP BY platform"""), ["1", "2", "3", "4"]))
def pivot_platform_facility(spark, sf_dir):
    r = materialize(R.dimension_rollup(_w(spark, sf_dir).dwd, "platform_facility"))
    return stable(M.pivot_matrix(r, "platform", "facility", "energy"))


@register("heatmap_dense", O.rounded(O.with_ctes(O.DWD, """
SELECT CAST(g.weekday AS INTEGER) AS weekday, CAST(g.hour AS INTEGER) AS hour,
       coalesce(r.sessions, 0) AS sessions, coalesce(r.energy, 0) AS energy
FROM (SELECT d.range + 1 AS weekday, h.range AS hour FROM range(7) d, range(24) h) g
LEFT JOIN (SELECT weekday, hour, count(*) AS sessions, sum(energy) AS energy FROM dwd GROUP BY weekday, hour) r
  ON g.weekday = r.weekday AND g.hour = r.hour"""), ["energy"]))
def heatmap_dense(spark, sf_dir):
    r = R.dimension_rollup(_w(spark, sf_dir).dwd, "weekday_hour")
    return stable(M.dense_grid(spark, r, ["sessions", "energy"]))


_CATS = [("month", "month"), ("hour", "hour"), ("weekday", "weekday"), ("duration", "duration_band"),
         ("energy", "energy_band"), ("location", "location")]


@register("mart_category", O.rounded(O.with_ctes(O.DWD, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS chart, CAST({k} AS VARCHAR) AS category, sum(energy) AS value FROM dwd GROUP BY {k}"
    for c, k in _CATS)), ["value"]))
def mart_category(spark, sf_dir):
    d = _w(spark, sf_dir).dwd
    dims = {c: R.DIMENSIONS[c] for c, _ in _CATS}
    return stable(M.category_series(R.rollup_all(d, dims), "energy"))


@register("mart_battery", O.rounded(O.with_ctes(O.BATTERY, """
SELECT CAST(floor(soc / 10) * 10 AS BIGINT) AS soc_band, avg(temperature) AS temperature, count(*) AS samples
FROM battery GROUP BY 1"""), ["temperature"]))
def mart_battery(spark, sf_dir):
    return stable(M.battery_points(B.battery_bands(_w(spark, sf_dir).battery_flagged)))


@register("display_round", O.rounded(O.with_ctes(O.DWD, f"""
SELECT platform, {O.MEASURES} FROM dwd GROUP BY platform"""), MEAS, 2))
def display_round(spark, sf_dir):
    return M.display(R.dimension_rollup(_w(spark, sf_dir).dwd, "platform"))


@register("mart_copy", O.rollup_sql(["station"]))
def mart_copy(spark, sf_dir):
    """The ADS table is a byte-for-byte copy of the DWS table it was
    published from (written, then copied, then read back)."""
    root = scratch_path(spark, "warehouse")
    RAW.write_layer(R.dimension_rollup(_w(spark, sf_dir).dwd, "station"), root, "dws", "station")
    RAW.write_layer(RAW.read_layer(spark, root, "dws", "station"), root, "ads", "station")
    return stable(RAW.read_layer(spark, root, "ads", "station"))


# ---------------------------------------------------------------- document and snapshots
def _document(spark, sf_dir):
    """The dashboard document over materialised DWD/telemetry tables (each
    input table is computed once, as in the job), written once as well."""
    from gridloom.operators import payload as P
    w = _w(spark, sf_dir)
    cl = materialize(w.classified)
    from gridloom.sources.fixtures import FIXTURE_CENTURY_YEARS
    dwd = materialize(S.enrich(S.dedup_accepted(cl, list(S.RAW_SESSION_COLUMNS), FIXTURE_CENTURY_YEARS),
                               w.stations))
    # telemetry flagged once: the clean table and both battery counters come from it
    battery_cl = materialize(B.classify_battery(B.type_battery(w.raw_battery)))
    battery = battery_cl.filter("is_valid").drop("is_valid")
    ql = Q.quality_counters(cl, dwd, {"stations": w.raw_stations}, battery_classified=battery_cl)
    gen = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return materialize(P.dashboard_document(dwd, battery, ql, gen))


@register("dashboard_payload", _LONG_SQL)
def dashboard_payload(spark, sf_dir):
    """S8 checked on exploded values: the JSON text is parsed back and flattened."""
    from gridloom.operators import payload as P
    doc = _document(spark, sf_dir)
    schema = doc.schema["doc"].dataType
    return stable(P.explode_document(doc.select("payload"), schema))


@register("document_file", _LONG_SQL)
def document_file(spark, sf_dir):
    """The document written as a text file, read back whole and flattened."""
    from gridloom.operators import payload as P
    doc = _document(spark, sf_dir)
    path = scratch_path(spark, "dashboard-json")
    RAW.write_document(doc, path)
    return stable(P.explode_document(RAW.read_document(spark, path), doc.schema["doc"].dataType))


def _publish_document(spark, sf_dir):
    from gridloom.operators import payload as P
    from gridloom.sources import snapshot as SN
    doc = _document(spark, sf_dir)
    root = scratch_path(spark, "snapshots")
    SN.publish(doc.select(F.col("doc.generated_at").alias("generated_at"), "payload"), root, "dashboard",
               checks=P.document_check(doc))
    return root, doc.schema["doc"].dataType


@register("snapshot_read", _LONG_SQL)
def snapshot_read(spark, sf_dir):
    """Validate and publish a version, then serve the latest one."""
    from gridloom.operators import payload as P
    from gridloom.sources import snapshot as SN
    root, schema = _publish_document(spark, sf_dir)
    return stable(P.explode_document(SN.read_latest(spark, root, "dashboard"), schema))


@register("snapshot_ready", O.with_ctes(O.DWD, """
SELECT CASE WHEN count(*) > 0 THEN 'ok' ELSE 'not_ready' END AS status, CAST(1 AS INTEGER) AS version,
       count(*) > 0 AS dated FROM dwd"""))
def snapshot_ready(spark, sf_dir):
    """readiness of the latest committed snapshot; ``dated``: it carries its publication time."""
    from gridloom.sources import snapshot as SN
    root, _ = _publish_document(spark, sf_dir)
    return SN.readiness(spark, root, "dashboard").select(
        "status", "version", F.col("generated_at").isNotNull().alias("dated"))


# ---------------------------------------------------------------- the whole job
@register("warehouse_job", _LONG_SQL)
def warehouse_job(spark, sf_dir):
    """Raw CSV files -> ODS -> DWD -> DWS -> ADS -> snapshot; the result is the
    published ADS long rollup read back from shared storage."""
    from gridloom.plans import warehouse as WH
    base = scratch_path(spark, "warehouse-job")
    paths = WH.write_fixture_sources(spark, _w(spark, sf_dir), base)
    from gridloom.sources.fixtures import FIXTURE_CENTURY_YEARS
    res = WH.build(spark, paths, base, century_years=FIXTURE_CENTURY_YEARS)
    return stable(RAW.read_layer(spark, res.root, "ads", "rollups"))


@register("overview_from_rollups", O.rounded(O.with_ctes(O.DWD, """
SELECT count(*) AS sessions, sum(energy) AS energy, sum(fees) AS fees, count(DISTINCT station) AS stations,
       avg(duration) AS avg_duration FROM dwd"""), ["energy", "fees", "avg_duration"]))
def overview_from_rollups(spark, sf_dir):
    """A14 as the document computes it: from the shared GROUPING SETS aggregate."""
    return stable(R.overview_from_grouped(R.grouped_sets(_w(spark, sf_dir).dwd)))
