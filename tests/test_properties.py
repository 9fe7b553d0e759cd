"""Invariants of the warehouse and the forecast, independent of the oracles."""
import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from gridloom.functions import columns as C
from gridloom.operators import calendar as CAL
from gridloom.operators import features as FE
from gridloom.operators import forecast as FC
from gridloom.operators import models as MD
from gridloom.operators import rollups as R
from gridloom.operators import series as SR
from gridloom.operators import sessions as S
from gridloom.plans.inputs import Inputs
from gridloom.session import scratch_path
from gridloom.sources import raw as RAW
from gridloom.sources import snapshot as SN
from gridloom.sources.fixtures import HOLIDAYS, MAKEUP_WORKDAYS, work_calendar


def test_accepted_plus_rejected_is_source(spark):
    w = Inputs(spark, MEDIUM)
    n = w.raw_sessions.count()
    acc, rej = w.accepted_rows.count(), S.rejected(w.classified).count()
    assert acc + rej == n
    # figures probed in FIXTURES.md
    assert (n, rej, w.clean.count()) == (10200, 567, 9442)


def test_every_dimension_reconciles(spark):
    d = Inputs(spark, MEDIUM).dwd
    total = d.count()
    sums = {r["dimension"]: r["s"] for r in R.rollup_all(d).groupBy("dimension")
            .agg(F.sum("sessions").alias("s")).collect()}
    assert len(sums) == 12 and set(sums.values()) == {total}


def test_key_conflict_guard_raises(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string")
    with pytest.raises(S.KeyConflictError):
        S.require_unique(df.dropDuplicates(), ["id"])
    S.require_unique(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), ["id"])
    assert S.key_conflicts(df, ["id"]).collect()[0]["rows"] == 2


def test_century_repair_only_listed_years(spark):
    df = spark.createDataFrame([("0014-01-02 03:04:05",), ("0016-01-02 03:04:05",), ("2014-1-2 3:4:5",)], "c string")
    out = df.select(C.repair_century("c").alias("r"), C.safe_timestamp(C.repair_century("c")).alias("t")).collect()
    assert out[0]["r"].startswith("2014-") and out[1]["r"].startswith("0016-")
    assert out[2]["t"] is None  # strict pattern


def test_bands_are_half_open(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.99,), (3.0,), (6.0,)], "d double")
    got = [r[0] for r in df.select(C.duration_band("d")).collect()]
    assert got == ["<1h", "1–3h", "1–3h", "3–6h", "≥6h"]


def test_csv_header_bom_and_blank_cells(spark):
    path = scratch_path(spark, "csv-test")
    src = spark.createDataFrame([("1", "  ", None)], "a string, b string, c string")
    RAW.write_csv(src, path, bom=True)
    back = RAW.read_raw(spark, path)
    assert back.columns == ["a", "b", "c"]
    row = back.first()
    assert row["b"] == "  " and row["c"] is None


def test_csv_empty_quoted_and_blank_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text('\ufeffa,b,c,d\n1,,"","  "\n', encoding="utf-8")
    df = RAW.read_raw(spark, str(tmp_path))
    assert df.columns == ["a", "b", "c", "d"]
    r = df.first()
    assert (r["b"], r["c"], r["d"]) == (None, None, "  ")


def test_failfast_rejects_malformed_csv(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text('a,b\n1,2\n3,4,5\n"x\n')
    with pytest.raises(Exception):
        RAW.read_raw(spark, str(p)).collect()


def test_snapshot_failure_keeps_previous_version(spark):
    root = scratch_path(spark, "snap-test")
    doc = spark.createDataFrame([("t1", '{"a":1}')], "generated_at string, payload string")
    ok = spark.createDataFrame([(True, None)], "ok boolean, reason string")
    bad = spark.createDataFrame([(False, "broken")], "ok boolean, reason string")
    assert SN.readiness(spark, root, "x").first()["status"] == "not_ready"
    assert SN.publish(doc, root, "x", ok) == 1
    with pytest.raises(SN.SnapshotError):
        SN.publish(doc.withColumn("payload", F.lit("{}")), root, "x", bad)
    assert SN.read_latest(spark, root, "x").first()["payload"] == '{"a":1}'
    assert SN.publish(doc, root, "x", ok) == 2
    assert SN.readiness(spark, root, "x").first()["version"] == 2


def test_snapshot_recovers_from_a_failed_write(spark):
    root = scratch_path(spark, "snap-test")
    doc = spark.createDataFrame([("t1", "{}")], "generated_at string, payload string")
    failing = doc.withColumn("payload", F.raise_error(F.lit("lost executor")).cast("string"))
    with pytest.raises(Exception, match="lost executor"):
        SN.publish(failing, root, "x")
    assert SN.latest_version(spark, root, "x") is None
    assert SN.publish(doc, root, "x") == 1
    with pytest.raises(Exception, match="lost executor"):
        SN.publish(failing, root, "x")
    # A version without a commit marker is never served, and never written to again.
    doc.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/x/version=2")
    assert SN.readiness(spark, root, "x").first()["version"] == 1
    assert SN.publish(doc, root, "x") == 3
    assert SN.readiness(spark, root, "x").first()["version"] == 3


def test_concurrent_writers_never_share_a_version(spark):
    root = scratch_path(spark, "snap-test")
    docs = [spark.createDataFrame([("t", str(i))], "generated_at string, payload string") for i in range(6)]
    with ThreadPoolExecutor(max_workers=6) as pool:
        versions = list(pool.map(lambda d: SN.publish(d, root, "x"), docs))
    assert sorted(versions) == [1, 2, 3, 4, 5, 6]
    for i, v in enumerate(versions):
        assert spark.read.parquet(f"{root}/x/version={v}").first()["payload"] == str(i)


def test_station_with_two_names_is_refused(spark):
    stations = spark.createDataFrame([("7", "a"), ("7", "a"), ("8", "b")], "stationId string, station_name string")
    assert sorted(map(tuple, S.dedup_stations(stations).collect())) == [("7", "a"), ("8", "b")]
    both = stations.union(spark.createDataFrame([("7", "c")], stations.schema))
    with pytest.raises(Exception, match="share stationId 7"):
        S.dedup_stations(both).collect()


def test_calendar_listing_a_date_twice_is_refused(spark):
    days = spark.sql("SELECT DATE '2024-05-01' AS stat_date")
    cal = spark.sql("SELECT DATE '2024-05-01' AS cal_date, false AS is_workday, 'a' AS holiday_name")
    assert CAL.with_calendar(days, cal).first()["is_holiday"] == 1
    with pytest.raises(Exception, match="listed more than once"):
        CAL.with_calendar(days, cal.union(cal)).collect()


def test_calendar_covers_the_longest_horizon(spark):
    daily = spark.sql("SELECT DATE '2024-12-31' AS stat_date, 5.0D AS total_kwh, 3 AS t")
    days = {str(r["stat_date"]): r["is_holiday"]
            for r in FC.future_frame(daily, 366, work_calendar(daily)).collect()}
    assert days["2026-01-01"] == 1 and days["2025-01-02"] == 0


def test_analyse_finds_what_lookup_finds(spark):
    dwd = Inputs(spark, SMALL).dwd
    long = R.rollup_all(dwd)
    for name in ("platform_facility", "station"):
        a, b = R.analyse(dwd, name).drop("avg_power"), R.lookup(long, name).drop("avg_power")
        a, b = ({tuple(r)[:4] for r in x.collect()} for x in (a, b))
        assert a == b and a


def test_recursive_forecast_matches_plain_loop(spark):
    hist = [100.0 + 7 * (i % 5) for i in range(20)]
    ratios = [0.8, 1.1, 3.5, -0.2, 1.0]
    d0 = "2024-01-01"
    h = spark.createDataFrame([(i, v) for i, v in enumerate(hist)], "i int, total_kwh double") \
        .select(F.date_add(F.lit(d0), F.col("i")).alias("stat_date"), "total_kwh")
    r = spark.createDataFrame([(i, v) for i, v in enumerate(ratios)], "i int, ratio double") \
        .select(F.date_add(F.lit(d0), F.col("i") + len(hist)).alias("stat_date"), "ratio")
    got = [row["pred"] for row in FC.recursive_forecast(h, r).orderBy("stat_date").collect()]
    kwh = list(hist)
    want = []
    for q in ratios:
        p = float(np.mean(kwh[-14:])) * min(max(q, 0.0), 3.0)
        kwh.append(p)
        want.append(p)
    assert np.allclose(got, want, rtol=1e-12)


def test_recursion_with_short_history(spark):
    h = spark.createDataFrame([("2024-01-01", 10.0), ("2024-01-02", 12.0)], "d string, total_kwh double") \
        .select(F.to_date("d").alias("stat_date"), "total_kwh")
    r = spark.createDataFrame([("2024-01-03", 1.0), ("2024-01-04", 2.0)], "d string, ratio double") \
        .select(F.to_date("d").alias("stat_date"), "ratio")
    got = [row["pred"] for row in FC.recursive_forecast(h, r).orderBy("stat_date").collect()]
    assert got == [11.0, pytest.approx(2 * (10 + 12 + 11) / 3)]


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(0)
    n = 200
    x = rng.normal(size=(n, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)],
                               "a double, b double, c double, y double")
    m = MD.fit("ridge", {}, ["a", "b", "c"], df, "y").stages[-1]
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + MD.RIDGE_ALPHA * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-8)
    assert math.isclose(m.intercept, y.mean() - x.mean(0) @ w, abs_tol=1e-8)


def test_features_do_not_leak_the_future(spark):
    w = Inputs(spark, SMALL)
    daily = SR.daily_series(w.order_sessions)
    cal = work_calendar(daily)
    day = daily.select("stat_date").orderBy("stat_date").offset(500).first()[0]
    changed = daily.withColumn("total_kwh", F.when(F.col("stat_date") == day, F.lit(1e12))
                               .otherwise(F.col("total_kwh")))
    cols = [c for c in FE.FEATURE_COLUMNS]
    a = FE.build_features(daily, cal).filter(F.col("stat_date") <= day).select("stat_date", *cols)
    b = FE.build_features(changed, cal).filter(F.col("stat_date") <= day).select("stat_date", *cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_horizon_bounds():
    assert FC.check_horizon(7) == 7
    for bad in (0, 367):
        with pytest.raises(ValueError):
            FC.check_horizon(bad)


def test_lookup_unknown_dimension(spark):
    long = R.rollup_all(Inputs(spark, SMALL).dwd)
    with pytest.raises(KeyError):
        R.lookup(long, "nope")


def test_calendar_rules(spark):
    years = spark.range(2024, 2026).select(F.col("id").cast("int").alias("year"))
    cal = CAL.calendar_from_years(years, HOLIDAYS, MAKEUP_WORKDAYS)
    days = spark.createDataFrame([("2024-01-01",), ("2024-05-04",), ("2024-01-06",), ("2024-01-08",)], "d string") \
        .select(F.to_date("d").alias("stat_date"))
    got = {str(r["stat_date"]): (r["is_rest"], r["is_holiday"], r["is_makeup"])
           for r in CAL.with_calendar(days, cal).collect()}
    assert got["2024-01-01"] == (1, 1, 0)      # holiday on a Monday
    assert got["2024-05-04"] == (0, 0, 1)      # Saturday worked
    assert got["2024-01-06"] == (1, 0, 0)      # plain Saturday
    assert got["2024-01-08"] == (0, 0, 0)      # plain Monday


def test_streaming_landing_matches_batch(spark):
    from gridloom.streaming import ingest
    from gridloom.sources.fixtures import FIXTURE_CENTURY_YEARS
    w = Inputs(spark, SMALL)
    base = scratch_path(spark, "stream-test")
    raw = w.raw_sessions
    # two files arriving separately
    RAW.write_csv(raw.filter(F.col("sessionId").endswith("1")), f"{base}/in/a")
    RAW.write_csv(raw.filter(~F.col("sessionId").endswith("1")), f"{base}/in/b")
    q = ingest.start(spark, f"{base}/in/*", f"{base}/landed", f"{base}/chk", FIXTURE_CENTURY_YEARS)
    q.awaitTermination(300)
    landed = ingest.read_landed(spark, f"{base}/landed")
    assert landed.count() == raw.count()
    assert landed.filter("is_valid").count() == w.accepted_rows.count()
    clean = S.dedup_accepted(landed, list(S.RAW_SESSION_COLUMNS), FIXTURE_CENTURY_YEARS)
    assert clean.count() == w.clean.count()


def test_streaming_refuses_a_file_with_another_column_order(spark):
    from gridloom.streaming import ingest
    raw = Inputs(spark, SMALL).raw_sessions
    cols = list(raw.columns)
    cols[1], cols[2] = cols[2], cols[1]
    base = scratch_path(spark, "stream-test")
    RAW.write_csv(raw.select(*cols), f"{base}/in/a")
    with pytest.raises(Exception):
        ingest.start(spark, f"{base}/in/*", f"{base}/landed", f"{base}/chk").awaitTermination(120)


def test_timestamps_keep_the_written_time_in_any_zone(spark):
    texts = ["2014-03-30 02:30:00", "2014-13-01 00:00:00", "2014-1-01 00:00:00", "2014-01-01 00:00:00\n", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = [r[0] for r in df.select(C.safe_timestamp("x").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2014-03-30 02:30:00", None, None, None, None, None]


@pytest.mark.parametrize("energy, sessions", [(float("nan"), 1.0), (1.0, float("inf")), (None, 1.0), (1.0, None)])
def test_forecast_document_refuses_unknown_values(spark, energy, sessions):
    hist = spark.createDataFrame([("2024-01-01", 2.0, 3)], "date string, energy double, sessions long")
    good = spark.createDataFrame([("2024-01-02", 2.0, 3.0)], "date string, energy double, sessions double")
    bad = spark.createDataFrame([("2024-01-02", energy, sessions)], good.schema)
    doc = FC.forecast_payload(hist, good, F.lit("now"))
    assert FC.payload_check(doc).first()["ok"] and '"sessions":3}' in doc.first()["payload"]
    assert not FC.payload_check(FC.forecast_payload(hist, bad, F.lit("now"))).first()["ok"]


def test_shuffle_join_fallback_with_hot_station(spark):
    """A third of all sessions on one station; the shuffle-join path (used
    when the dimension is too large to broadcast) gives the same rows."""
    w = Inputs(spark, MEDIUM)
    hot = w.clean.withColumn("stationId", F.when(F.col("session_id") % 3 == 0, F.lit("7"))
                             .otherwise(F.col("stationId")))
    a = S.enrich(hot, w.stations).collect()
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:   # a dimension too large for Spark's own size estimate as well
            spark.conf.set(k, "-1")
        b = S.enrich(hot, w.stations)
        rows_b = b.collect()
        plan_b = b._jdf.queryExecution().executedPlan().toString()
        top = R.rollup(b, ["station"]).orderBy(F.col("sessions").desc()).first()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in plan_b and "SortMergeJoin" in plan_b
    assert sorted(map(tuple, a)) == sorted(map(tuple, rows_b)) and len(a) == hot.count()
    assert top["station"] == "7" and top["sessions"] >= len(a) // 3


def _document(spark, sf):
    import json
    from gridloom.plans.queries_warehouse import _document as build_doc
    return json.loads(build_doc(spark, sf).select("payload").first()["payload"])


def test_document_totals_cross_tabs_and_band_order(spark):
    """The reference's own warehouse checks, on the published document."""
    doc = _document(spark, MEDIUM)
    ov, dims = doc["overview"], doc["dimensions"]
    w = Inputs(spark, MEDIUM)
    src = w.clean.agg(F.count(F.lit(1)).alias("n"), F.sum("energy").alias("e"), F.sum("fees").alias("f")).first()
    assert ov["sessions"] == src["n"] == 9442 and doc["quality"]["rejected_sessions"] == 567
    assert doc["quality"]["duplicates_removed"] == 191 and doc["quality"]["source_rows"]["sessions"] == 10200
    for rows in dims.values():   # every dimension re-sums to the totals
        assert sum(r["sessions"] for r in rows) == ov["sessions"]
        assert math.isclose(sum(r["energy"] for r in rows), src["e"], rel_tol=1e-9)
        assert math.isclose(sum(r["fees"] for r in rows), src["f"], rel_tol=1e-9)
    # weekday x hour recomputed from the accepted rows with Python's calendar
    want = {}
    for r in w.clean.select("started").collect():
        k = (r["started"].isoweekday(), r["started"].hour)
        want[k] = want.get(k, 0) + 1
    assert {(r["weekday"], r["hour"]): r["sessions"] for r in dims["weekday_hour"]} == want
    for name, labels in (("duration", C.DURATION_LABELS), ("energy", C.ENERGY_LABELS)):
        got = [r[R.DIMENSIONS[name][0]] for r in dims[name]]
        assert got == [x for x in labels if x in got]
    assert [r["soc_band"] for r in doc["battery"]] == sorted(r["soc_band"] for r in doc["battery"])


def test_forecast_payload_rejects_non_finite(spark):
    pts = spark.createDataFrame([("2024-01-01", 1.0, 2.0)], "date string, energy double, sessions double")
    bad = spark.createDataFrame([("2024-01-02", float("nan"), 2.0)], "date string, energy double, sessions double")
    ok_doc = FC.forecast_payload(pts, pts.withColumn("date", F.lit("2024-01-02")), F.lit("now"))
    bad_doc = FC.forecast_payload(pts, bad, F.lit("now"))
    assert FC.payload_check(ok_doc).first()["ok"] is True
    assert FC.payload_check(bad_doc).first()["ok"] is False
    empty = FC.forecast_payload(pts, bad.limit(0), F.lit("now"))
    assert FC.payload_check(empty).first()["ok"] in (False, None)


def test_unique_rows_by_key_equals_drop_duplicates(spark):
    w = Inputs(spark, MEDIUM)
    cols = list(S.RAW_SESSION_COLUMNS)
    keyed = S.unique_rows_by_key(w.accepted_rows, "session_id", cols)
    assert keyed.filter("_conflict").count() == 0
    a = keyed.drop("_conflict")
    b = w.accepted_rows.select(*cols).dropDuplicates()
    assert a.count() == b.count() == 9442 and a.exceptAll(b).count() == 0
    conflicting = w.accepted_rows.select(*cols).limit(3).withColumn("platform", F.lit("other"))
    both = w.accepted_rows.unionByName(S.type_sessions(conflicting, ("24",)))
    assert S.unique_rows_by_key(both, "session_id", cols).filter("_conflict").count() == 3


def test_quality_counters_one_pass_equals_separate_counts(spark):
    """Battery counters from the flagged telemetry (one aggregate) equal the
    counts of the raw and the clean telemetry; the session source count from
    the classification equals the raw row count."""
    from gridloom.operators import quality as Q
    from gridloom.operators import telemetry as B
    w = Inputs(spark, SMALL)
    one = Q.quality_counters(w.classified, w.dwd, {"stations": w.raw_stations},
                             battery_classified=B.classify_battery(B.type_battery(w.raw_battery)))
    sep = Q.quality_counters(w.classified, w.dwd, {"sessions": w.raw_sessions, "battery": w.raw_battery,
                                                   "stations": w.raw_stations}, w.battery)
    a = {r["metric"]: r["value"] for r in one.collect()}
    b = {r["metric"]: r["value"] for r in sep.collect()}
    assert a == b
    assert a["source_rows.sessions"] == w.raw_sessions.count()
    assert a["source_rows.battery"] == w.raw_battery.count() and a["battery_accepted"] == w.battery.count()
    assert a["duplicates_removed"] == a["source_rows.sessions"] - a["accepted_sessions"] - a["rejected_sessions"]


def test_battery_bands_flagged_equals_clean(spark):
    """Conditional aggregation over flagged telemetry equals the plain
    aggregate over the clean rows (including rows with NULL or out-of-range fields)."""
    from gridloom.operators import telemetry as B
    w = Inputs(spark, SMALL)
    extra = spark.createDataFrame([("1", None, "20", "4.1", "4.0"), ("2", "150", "20", "4.1", "4.0"),
                                   ("3", "55", "20", "9", "1"), ("4", "55", "20", "4.1", "4.0")],
                                  ", ".join(f"`{c}` string" for c in w.raw_battery.columns))
    raw = w.raw_battery.unionByName(extra)
    flagged = B.battery_bands(B.classify_battery(B.type_battery(raw)))
    clean = B.battery_bands(B.clean_battery(B.type_battery(raw)))
    assert flagged.count() == clean.count() and flagged.exceptAll(clean).count() == 0


def test_ratio_functions_propagate_null_and_nan(spark):
    from gridloom.functions import columns as C
    nan = float("nan")
    df = spark.createDataFrame([(12.0, None), (12.0, nan), (None, 1.0), (nan, 1.0), (0.0, 1.0), (10.0, 20.0)],
                               "anchor double, x double")
    rows = df.select(C.log_ratio("x", "anchor").alias("z"), C.clip_ratio("x").alias("c"),
                     C.ratio_inverse("x", "anchor", False).alias("p")).collect()
    assert [r.z for r in rows[:5]] == [None] * 5 and abs(rows[5].z - 0.6931471805599453) < 1e-12
    assert [r.c for r in rows] == [None, None, 1.0, 1.0, 1.0, 3.0]
    assert [r.p for r in rows] == [None, None, None, None, 0.0, 30.0]


def test_rounding_never_moves_a_large_value(spark):
    from gridloom.functions import columns as C
    assert spark.sql("SELECT 3758439620.1D AS x").select(C.round_half_up("x", 1).alias("y")).first().y == 3758439620.1


def test_key_conflicts_by_digests(spark):
    """Nulls in keys and columns, swapped nulls, repeated rows and many rows of one key."""
    rows = [(1, "a", None), (1, None, "a"), (2, "x", "y"), (2, "x", "y"), (None, "p", "q"), (None, "p", "r"), (None, "p", "r"),
            (3, None, None), (3, None, None), (4, "", None), (4, None, None), *[(5, str(i % 7), "z") for i in range(700)]]
    df = spark.createDataFrame(rows, "id long, v string, w string")
    assert {(r["id"], r["rows"]) for r in S.key_conflicts(df, ["id"]).collect()} == {(1, 2), (None, 2), (4, 2), (5, 7)}
    assert S.key_conflicts(df.limit(0), ["id"]).count() == 0
