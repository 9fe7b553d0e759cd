"""Plan shapes the scale design relies on, read from the physical plan
(before execution): one grouping-sets shuffle for all rollups, pruned scans,
one scan per table for the counters, filters placed where they are cheap."""
import re

from conftest import SMALL

import __spark_entry__ as entry
from gridloom.operators import series as SR
from gridloom.plans.inputs import Inputs


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _query_plan(spark, name: str) -> str:
    return _plan(entry.queries()[name](spark, SMALL))


def _scans(plan: str, table: str) -> list[str]:
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln and f"/{table}.parquet" in ln]


def _scan_columns(line: str) -> set[str]:
    cols = re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1)
    return {c.split("#")[0] for c in cols.split(",") if c}


def test_twelve_rollups_are_one_grouping_sets_shuffle(spark):
    p = _query_plan(spark, "rollup_all")
    lines = p.splitlines()
    assert sum("Expand [" in ln for ln in lines) == 1
    grouped = [ln for ln in lines if "Exchange hashpartitioning" in ln and "spark_grouping_id" in ln]
    assert len(grouped) == 1
    # partial aggregation runs below the shuffle, on the expanded rows
    below = lines[lines.index(grouped[0]) + 1:]
    assert any("HashAggregate" in ln and "partial_count" in ln for ln in below)


def test_category_charts_share_one_aggregate(spark):
    lines = _query_plan(spark, "mart_category").splitlines()
    assert sum("Expand [" in ln for ln in lines) == 1
    assert "Union" not in "".join(lines)


def test_lookup_of_one_dimension_expands_nothing(spark):
    assert "Expand [" not in _query_plan(spark, "analysis_lookup")


def test_small_station_table_is_broadcast_by_its_bytes(spark):
    p = _query_plan(spark, "sessions_enriched")
    assert "BroadcastHashJoin" in p and "LeftOuter" in p and "SortMergeJoin" not in p


def test_validity_filter_runs_after_the_dedup_aggregate(spark):
    """No filter re-evaluates the typing expressions: the accepted rows are
    kept after the aggregate, on a plain boolean column."""
    p = _query_plan(spark, "dedup_exact")
    lines = p.splitlines()
    filters = [i for i, ln in enumerate(lines) if re.search(r"\bFilter ", ln)]
    assert filters and not any("try_" in lines[i] for i in filters)
    first_agg = next(i for i, ln in enumerate(lines) if "HashAggregate" in ln)
    assert all(i < first_agg for i in filters)   # printed above = runs after
    assert all("DataFilters: []" in ln for ln in _scans(p, "events"))


def test_quality_counters_scan_each_table_once(spark):
    p = _query_plan(spark, "quality_counters")
    assert len(_scans(p, "lineitem")) == 1          # source and accepted telemetry in one aggregate
    assert len(_scans(p, "events")) <= 2            # classification + deduplicated sessions
    assert len(_scans(p, "customer")) <= 2          # station join + station source count


def test_daily_series_reads_only_its_columns(spark):
    daily = SR.daily_series(Inputs(spark, SMALL).order_sessions)
    scans = _scans(_plan(daily), "orders")
    assert len(scans) == 1
    assert _scan_columns(scans[0]) == {"o_custkey", "o_totalprice", "o_orderdate"}


def test_key_guard_is_one_hashed_exchange(spark):
    """The conflict guard moves fixed-width digests: hashed, combined before its one shuffle, no sort."""
    from gridloom.operators import sessions as S
    p = _plan(S.conflicting_keys(Inputs(spark, SMALL).table("lineitem"), ["l_orderkey", "l_linenumber"]))
    assert p.count("Exchange ") == 1 and "SortAggregate" not in p and p.count("HashAggregate") == 2


def test_job_dedup_is_hashed(spark):
    from gridloom.operators import sessions as S
    raw = Inputs(spark, SMALL).raw_sessions
    p = _plan(S.dedup(S.accepted(S.classify(S.type_sessions(raw))).select(*raw.columns)))
    assert "SortAggregate" not in p and p.count("Exchange ") == 1
