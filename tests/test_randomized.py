"""Randomized check of the accept rule against an independent Python
implementation (the reference's own warehouse test re-derives validity with
Python's parsers in the same way)."""
import math
import re
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridloom.operators import sessions as S

IDS = ["1", "2", "42", "x3", " 4 ", "", None, "-5", "1.5"]
NUMS = ["1.5", "0", "-1", "NaN", "abc", "999999999", "1e9", "2.25", "", None]
DURS = ["0", "0.5", "2", "1e6", "999999", "-2", "x", None]
TS = ["0014-01-02 03:04:05", "0015-06-07 08:09:10", "2014-01-02 03:04:05", "0016-01-02 03:04:05",
      "2014-1-2 3:4:5", "2015-02-30 00:00:00", "", None]
STATIONS = ["s1", "s2", None]

row = st.tuples(st.sampled_from(IDS), st.sampled_from(NUMS), st.sampled_from(NUMS), st.sampled_from(DURS),
                st.sampled_from(TS), st.sampled_from(TS), st.sampled_from(STATIONS))

_TS = re.compile(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")


def _long(s):
    if s is None or not re.fullmatch(r"\s*[+-]?\d+\s*", s):
        return None
    return int(s)


def _double(s):
    if s is None:
        return None
    try:
        return float(s)
    except ValueError:
        return None


def _ts(s):
    if s is None:
        return None
    s = re.sub(r"^00(14|15)-", r"20\1-", s)
    if not _TS.match(s):
        return None
    try:
        return datetime.strptime(s, "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


def py_valid(r):
    sid, kwh, fee, dur, c, e, station = r
    energy, fees, duration = _double(kwh), _double(fee), _double(dur)
    started, finished = _ts(c), _ts(e)
    def inside(x, lo, hi, lo_strict=False):
        return x is not None and not math.isnan(x) and (x > lo if lo_strict else x >= lo) and x < hi
    return (_long(sid) is not None and inside(energy, 0, 1e9) and inside(fees, 0, 1e9)
            and inside(duration, 0, 1e6, lo_strict=True) and started is not None and finished is not None
            and finished >= started and station is not None)


COLS = ["sessionId", "kwhTotal", "charging_fees", "chargeTimeHrs", "created", "ended", "stationId"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30))
def test_accept_rule_matches_python(spark, rows):
    schema = ", ".join(f"{c} string" for c in COLS)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "rid int, " + schema)
    cl = S.classify(S.type_sessions(df))
    got = {r["rid"]: r["is_valid"] for r in cl.select("rid", "is_valid").collect()}
    assert len(got) == len(rows)
    assert all(v is not None for v in got.values())          # unknown counts as invalid
    want = {i: py_valid(r) for i, r in enumerate(rows)}
    assert got == want
    acc, rej = S.accepted(cl).count(), S.rejected(cl).count()
    assert acc + rej == len(rows)
    clean = S.dedup(S.accepted(cl).drop("rid"))
    assert clean.count() == len({r for i, r in enumerate(rows) if want[i]})
