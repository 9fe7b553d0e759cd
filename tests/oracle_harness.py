"""Run a catalog query in Spark and its oracle in DuckDB; compare row count,
column names/types and order-insensitive values.

CLI: ``python tests/oracle_harness.py [sf_dir] [name ...]``
(``ORACLE_EXACT=1`` compares doubles exactly).
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sql: str, sf_dir: str) -> pa.Table:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con.sql(sql).to_arrow_table()


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


# ORACLE_EXACT=1 compares doubles bit for bit (as a value hash would);
# by default they are compared at 9 decimals.
EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm_val(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v if EXACT else round(v, 9)
    if isinstance(v, list):
        return tuple(_norm_val(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_val(x)) for k, x in v.items()))
    return v


def _rows(t: pa.Table) -> list:
    names = sorted(t.column_names)
    cols = [t.column(n).to_pylist() for n in names]
    rows = [tuple(_norm_val(c[i]) for c in cols) for i in range(t.num_rows)]
    return sorted(rows, key=lambda r: tuple((x is None, repr(x)) for x in r))


def compare(spark_tbl: pa.Table, oracle_tbl: pa.Table) -> list[str]:
    problems = []
    if sorted(spark_tbl.column_names) != sorted(oracle_tbl.column_names):
        problems.append(f"columns {sorted(spark_tbl.column_names)} vs {sorted(oracle_tbl.column_names)}")
        return problems
    for n in spark_tbl.column_names:
        a, b = _norm_type(spark_tbl.schema.field(n).type), _norm_type(oracle_tbl.schema.field(n).type)
        if a != b:
            problems.append(f"type {n}: {a} vs {b}")
    if spark_tbl.num_rows != oracle_tbl.num_rows:
        problems.append(f"rows {spark_tbl.num_rows} vs {oracle_tbl.num_rows}")
        return problems
    ra, rb = _rows(spark_tbl), _rows(oracle_tbl)
    if ra != rb:
        diff = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems


def check(spark, sf_dir: str, names=None, verbose=True) -> dict:
    from __spark_entry__ import oracle_sql, queries
    qs, os_ = queries(), oracle_sql()
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            st = qs[name](spark, sf_dir).toArrow()
            if name in os_:
                probs = compare(st, duck(os_[name], sf_dir))
            else:
                probs = [] if st.num_rows >= 0 else ["no rows"]
            results[name] = probs
        except Exception as e:  # noqa: BLE001
            results[name] = [f"error {type(e).__name__}: {str(e)[:400]}"]
        if verbose:
            tag = "ok " if not results[name] else "BAD"
            kind = "X" if name in os_ else "T"
            print(f"{tag} {kind} {name:32s} {time.time() - t0:6.2f}s {'; '.join(results[name])[:600]}", flush=True)
    return results


if __name__ == "__main__":
    from gridloom.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = check(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
