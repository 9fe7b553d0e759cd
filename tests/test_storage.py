"""Schema sidecar, versioned model bundle, finite documents and presentation order."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL

from gridloom.operators import models as MD
from gridloom.operators import payload as PL
from gridloom.operators import quality as Q
from gridloom.operators import rollups as R
from gridloom.operators import series as SR
from gridloom.plans import catalog  # noqa: F401  registers the queries in order
from gridloom.sources import raw
from gridloom.sources import snapshot as SN


def test_orc_comments_come_back(spark, tmp_path):
    path = str(tmp_path / "typed")
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "n bigint, s string, x double")
    raw.write_typed_orc(df, path, {"n": "number", "x": "a \"quoted\" märk"})
    back = raw.read_typed_orc(spark, path)
    assert {f.name: f.metadata.get("comment") for f in back.schema} == {"n": "number", "s": None, "x": "a \"quoted\" märk"}
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    raw.write_typed_orc(df.select("n", "s"), path, {})
    assert [f.name for f in raw.read_typed_orc(spark, path).schema] == ["n", "s"]
    df.withColumn("n", F.col("n").cast("string")).write.mode("append").orc(path)
    df.select("x").coalesce(1).write.mode("overwrite").orc(path)
    with pytest.raises(Exception):
        raw.read_typed_orc(spark, path)


def _bundle(spark, t_max):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(20)], "a double, y double")
    return MD.Bundle(MD.fit("gbt", {"maxIter": 1, "maxDepth": 1}, ["a"], df, "y"), ["a"], "y", "roll14_kwh", True, t_max)


def test_bundle_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bundle")
    with pytest.raises(SN.SnapshotError):
        MD.Bundle.load(spark, path)
    assert _bundle(spark, 1).save(spark, path) == 1
    assert _bundle(spark, 2).save(spark, path) == 2
    assert MD.Bundle.load(spark, path).t_max == 2 and MD.Bundle.load(spark, path, 1).t_max == 1
    broken = _bundle(spark, 3)
    monkeypatch.setattr(SN, "mark_complete", lambda *_: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        broken.save(spark, path)
    assert MD.Bundle.load(spark, path).t_max == 2
    with pytest.raises(SN.SnapshotError):
        MD.Bundle.load(spark, path, 3)


NESTED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()),
    T.StructField("rows", T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.FloatType())]))),
    T.StructField("m", T.MapType(T.StringType(), T.ArrayType(T.DoubleType())))])


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_a_bad_number_at_any_depth_is_found(spark, bad):
    good = [(1, 1.0, [("a", 1.0), ("b", None)], {"p": [1.0, None]}), (None, None, None, None), (1, 2.0, [], {})]
    wrong = [(1, bad, [], {}), (1, 1.0, [("a", 1.0), ("b", bad)], {}), (1, 1.0, None, {"p": [1.0], "q": [bad]})]
    df = spark.createDataFrame([(g,) for g in good + wrong], T.StructType([T.StructField("doc", NESTED)]))
    got = [r.ok for r in df.select(Q.all_finite(F.col("doc"), NESTED).alias("ok")).collect()]
    assert got == [True] * 3 + [False] * 3


def _spoiled(value, kind, at):
    """The value with its ``at``-th floating number, in schema order, replaced by NaN; and how many there are."""
    if isinstance(kind, T.DoubleType):
        return (F.lit(float("nan")) if at == 0 else value), 1
    if isinstance(kind, T.StructType):
        fields, seen = [], 0
        for f in kind.fields:
            new, n = _spoiled(value[f.name], f.dataType, at - seen)
            fields.append(new.alias(f.name))
            seen += n
        return F.struct(*fields), seen
    if isinstance(kind, T.ArrayType):
        _, n = _spoiled(F.lit(None), kind.elementType, -1)
        if not 0 <= at < n:
            return value, n
        return F.transform(value, lambda x: _spoiled(x, kind.elementType, at)[0]), n
    return value, 0


def test_every_number_of_the_dashboard_is_checked(spark):
    from gridloom.plans.queries_warehouse import _w
    w = _w(spark, SMALL)
    quality = spark.createDataFrame([("source_rows.a", 3), ("accepted_sessions", 1), ("rejected_sessions", 1),
                                     ("duplicates_removed", 1), ("battery_accepted", 0)], "metric string, value bigint")
    from gridloom.session import materialize
    doc = materialize(PL.dashboard_document(w.dwd, w.battery, quality, F.lit("now")))
    assert PL.document_check(doc).first()["ok"]
    kind = doc.schema["doc"].dataType
    count = _spoiled(F.col("doc"), kind, -1)[1]
    assert count > 40
    for at in range(0, count, 5):
        row = PL.document_check(doc.select(_spoiled(F.col("doc"), kind, at)[0].alias("doc"))).first()
        assert not row["ok"] and row["reason"] == "non-finite measure", at


def test_presentation_order(spark):
    from gridloom.plans.queries_warehouse import _w
    dwd = _w(spark, SMALL).dwd
    for name in ("duration", "energy", "weekday_hour", "platform"):
        key = R.DIMENSIONS[name][0]
        shown = [r[key] for r in R.order_rollup(R.dimension_rollup(dwd, name), name).collect()]
        want = [b for b in R.BAND_LABELS[name] if b in shown] if name in R.BAND_LABELS else sorted(shown)
        assert shown == want
    daily = spark.createDataFrame([("2024-01-03", "5", "1"), ("2024-01-01", "x", "2"), ("2024-01-02", "7.5", None)],
                                  "stat_date string, total_kwh string, sessions string")
    got = [tuple(r) for r in SR.load_series(daily, ordered=True).select("stat_date", "total_kwh", "sessions").collect()]
    assert got == [("2024-01-01", None, 2), ("2024-01-02", 7.5, None), ("2024-01-03", 5.0, 1)]


def test_layer_stays_whole(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(SN.SnapshotError):
        raw.read_layer(spark, root, "dwd", "t")
    first = spark.range(5).withColumn("part", F.col("id") % 2)
    raw.write_layer(first, root, "dwd", "t", partition_by=["part"])
    held = raw.read_layer(spark, root, "dwd", "t")
    assert sorted(held.columns) == ["id", "part"] and held.count() == 5
    # A write that fails half way leaves no version.
    broken = spark.range(100).withColumn("part", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit(0)))
    with pytest.raises(Exception, match="lost"):
        raw.write_layer(broken, root, "dwd", "t", partition_by=["part"])
    assert raw.read_layer(spark, root, "dwd", "t").count() == 5
    # One that is killed before its rename leaves an attempt that no reader meets.
    spark.range(7).write.parquet(SN.attempt_path(f"{root}/dwd/t"))
    assert raw.read_layer(spark, root, "dwd", "t").count() == 5
    # A reader of the version before goes on during and after a rerun.
    raw.write_layer(spark.range(9), root, "dwd", "t")
    assert held.count() == 5 and raw.read_layer(spark, root, "dwd", "t").count() == 9
    raw.write_layer(raw.read_layer(spark, root, "dwd", "t").filter("id > 0"), root, "dwd", "t")
    assert raw.read_layer(spark, root, "dwd", "t").count() == 8
    assert raw.read_layer(spark, root, "dwd", "t", version=2).count() == 9
    with pytest.raises(SN.SnapshotError):
        raw.read_layer(spark, root, "dwd", "t", version=1)


def test_report_and_document_files(spark, tmp_path):
    report = spark.createDataFrame([("2024-01-01", "Mon", 1, 2.5), ("2024-01-02", None, 0, None)],
                                   "d string, weekday string, is_holiday int, pred double")
    path = str(tmp_path / "report")
    raw.write_report(report, path)
    assert sorted(map(tuple, raw.read_report(spark, path, report.schema).collect())) == sorted(map(tuple, report.collect()))
    other = report.select(F.lit("x").alias("other"), *report.columns[1:]).schema
    with pytest.raises(Exception):
        raw.read_report(spark, path, other).collect()
    text = '{"name": "é \\n 京"}'
    raw.write_document(spark.createDataFrame([(text,)], "payload string"), str(tmp_path / "doc"))
    assert raw.read_document(spark, str(tmp_path / "doc")).first()["payload"].strip() == text
