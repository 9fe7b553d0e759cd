"""Dashboard document (S8): overview, twelve dimensions, battery bands and
quality counters as ONE JSON text, built in Spark.

The dimension arrays come from the same GROUPING SETS aggregate as the long
rollup; the final aggregate runs over those small grouped rows (bounded by the
key cardinalities), never over sessions, and nothing is collected to the
driver.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import columns as C
from gridloom.operators import quality as Q
from gridloom.operators import rollups as R


def dimension_arrays(grouped: DataFrame, dimensions: Mapping[str, Sequence[str]] = R.DIMENSIONS) -> DataFrame:
    """One row, one array column per dimension, from the GROUPING SETS output
    (:func:`rollups.grouped_sets`): rows ``keys..., measures`` in presentation
    order (keys; bands by numeric position)."""
    cols = R.key_columns(dimensions)
    outs = []
    for name, keys in dimensions.items():
        gid = R.grouping_id_of(keys, cols)
        row = F.struct(*[F.col(k) for k in keys], *[F.col(m) for m in R.MEASURE_NAMES])
        if name in R.BAND_LABELS:
            order = C.band_order(keys[0], R.BAND_LABELS[name])
            items = F.collect_list(F.when(F.col("_gid") == gid, F.struct(order.alias("o"), row.alias("r"))))
            outs.append(F.transform(F.sort_array(items), lambda x: x["r"]).alias(name))
        else:
            outs.append(F.sort_array(F.collect_list(F.when(F.col("_gid") == gid, row))).alias(name))
    return grouped.agg(*outs)


def _one(df: DataFrame, col: Column, name: str) -> DataFrame:
    return df.select(col.alias(name)).withColumn("_k", F.lit(1))


def dashboard_document(dwd: DataFrame, battery: DataFrame, quality_long: DataFrame,
                       generated_at: Column, grouped: DataFrame | None = None) -> DataFrame:
    """One row ``doc`` (struct) and ``payload`` (JSON text). Pass ``grouped``
    when the GROUPING SETS aggregate is already materialised."""
    from gridloom.operators.telemetry import battery_bands
    grouped = grouped if grouped is not None else R.grouped_sets(dwd)
    dims = dimension_arrays(grouped)
    dims = _one(dims, F.struct(*[F.col(c) for c in dims.columns]), "dimensions")
    ov = _one(R.overview_from_grouped(grouped),
              F.struct("sessions", "energy", "fees", "stations", "avg_duration"), "overview")
    bands = battery_bands(battery).agg(F.sort_array(F.collect_list(
        F.struct("soc_band", "samples", "temperature", "voltage_spread"))).alias("b"))
    bt = _one(bands, F.col("b"), "battery")
    q = quality_long.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    src = F.map_from_entries(F.filter(F.map_entries(F.col("m")), lambda e: e["key"].startswith("source_rows."))
                             .alias("x"))
    qual = _one(q, F.struct(
        F.transform_keys(src, lambda k, v: F.substring(k, 13, 100)).alias("source_rows"),
        F.col("m")["accepted_sessions"].alias("accepted_sessions"),
        F.col("m")["rejected_sessions"].alias("rejected_sessions"),
        F.col("m")["duplicates_removed"].alias("duplicates_removed"),
        F.col("m")["battery_accepted"].alias("battery_accepted"),
        F.lit(Q.YEAR_POLICY).alias("year_policy"), F.lit(Q.TELEMETRY_TIME).alias("telemetry_time")), "quality")
    j = dims
    for part in (ov, bt, qual):  # four one-row frames joined on a constant key
        j = j.join(F.broadcast(part), "_k")
    doc = F.struct(generated_at.alias("generated_at"), "overview", "dimensions", "battery", "quality")
    return j.select(doc.alias("doc")).select("doc", F.to_json("doc").alias("payload"))


def document_check(doc_df: DataFrame, min_dimensions: int = Q.MIN_DIMENSIONS) -> DataFrame:
    """F8/F9 before publication: total > 0, all dimensions present, each sums
    to the total, and every number at any depth is finite. One row ``ok, reason``."""
    d = F.col("doc")
    dims_t = doc_df.schema["doc"].dataType["dimensions"].dataType
    names = [f.name for f in dims_t.fields]
    total = d["overview"]["sessions"]
    sums = [F.aggregate(d["dimensions"][n], F.lit(0).cast("bigint"), lambda a, r: a + r["sessions"]) for n in names]
    reconciled = F.lit(True)
    for s in sums:
        reconciled = reconciled & (s == total)
    finite = Q.all_finite(d, doc_df.schema["doc"].dataType)
    ok = (total > 0) & F.lit(len(names) >= min_dimensions) & reconciled & finite
    return doc_df.select(ok.alias("ok"), F.when(total <= 0, "empty snapshot")
                         .when(F.lit(len(names) < min_dimensions), "incomplete snapshot")
                         .when(~reconciled, "reconciliation failed")
                         .when(~finite, "non-finite measure").alias("reason"))


def explode_document(payload: DataFrame, schema: T.StructType,
                     dimensions: Mapping[str, Sequence[str]] = R.DIMENSIONS) -> DataFrame:
    """Parse the JSON text back and flatten the dimensions to the long table
    ``dimension, key1, key2, measures`` (used to check the document)."""
    def long_rows(name: str, keys: Sequence[str]) -> Column:
        return F.transform(F.col("d.dimensions")[name], lambda r: F.struct(
            F.lit(name).alias("dimension"), r[keys[0]].cast("string").alias("key1"),
            (r[keys[1]].cast("string") if len(keys) > 1 else F.lit(None).cast("string")).alias("key2"),
            *[r[m].alias(m) for m in R.MEASURE_NAMES]))

    # The text is parsed once, whatever the number of dimensions.
    parsed = payload.select(F.from_json("payload", schema).alias("d"))
    return parsed.select(F.inline(F.concat(*[long_rows(name, keys) for name, keys in dimensions.items()])))
