"""Column expressions used throughout the warehouse.

Every helper returns a ``pyspark.sql.Column`` built from built-in functions, so
all of them stay inside whole-stage code generation; none is a Python UDF.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
# Session timestamps are written as `yyyy-MM-dd HH:mm:ss`.
TIMESTAMP_SHAPE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2})\z"  # yyyy-MM-dd HH:mm:ss
# Years written with a `00` century that are read as `20yy`.
DEFAULT_CENTURY_YEARS = ("14", "15")
# Label used for missing dimension values.
UNKNOWN = "unknown"
# Prefix of the fallback station label.
STATION_LABEL_PREFIX = "站点 "
# Half-open duration bands in hours: cut points and labels (en dash U+2013).
DURATION_CUTS = (1, 3, 6)
DURATION_LABELS = ("<1h", "1–3h", "3–6h", "≥6h")
# Half-open energy bands in kWh.
ENERGY_CUTS = (5, 10, 20)
ENERGY_LABELS = ("<5kWh", "5–10kWh", "10–20kWh", "≥20kWh")
# Lower clip of the ratio before the logarithm, and the ratio clip range.
LOG_RATIO_FLOOR = 1e-3
RATIO_MIN, RATIO_MAX = 0.0, 3.0
# sMAPE denominator guard.
SMAPE_EPS = 1e-9


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P1 / P21: null-on-failure casts ---------------------------------------
def safe_long(c) -> Column:
    return col(c).try_cast("bigint")


def safe_double(c) -> Column:
    return col(c).try_cast("double")


# --- P2: century repair ------------------------------------------------------
def century_pattern(years: Sequence[str] = DEFAULT_CENTURY_YEARS) -> str:
    return "^00(" + "|".join(years) + ")-"


def repair_century(c, years: Sequence[str] = DEFAULT_CENTURY_YEARS) -> Column:
    """`00yy-` becomes `20yy-` for the listed years only; other years untouched."""
    return F.regexp_replace(col(c), century_pattern(years), "20$1-")


# --- P3: strict timestamp parse ----------------------------------------------
def safe_timestamp(c) -> Column:
    """Strict parse, NULL on failure; wall-clock result (TIMESTAMP_NTZ).

    No zone takes part, so an hour that the session zone skips stays as written.
    """
    return F.regexp_extract(col(c), TIMESTAMP_SHAPE, 1).try_cast("timestamp_ntz")


# --- P4-P6: calendar keys -----------------------------------------------------
def month_key(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def iso_weekday(ts) -> Column:
    """Monday=1 ... Sunday=7."""
    return F.pmod(F.dayofweek(col(ts)) + 5, 7) + 1


# --- P7 / P8: defaults ---------------------------------------------------------
def blank_to_default(c, default: str = UNKNOWN) -> Column:
    return F.coalesce(F.nullif(F.trim(col(c)), F.lit("")), F.lit(default))


def null_to_default(c, default: str = UNKNOWN) -> Column:
    return F.coalesce(col(c), F.lit(default))


# --- P9 / P10 / O2: bands --------------------------------------------------------
def band(c, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open bands: value < cuts[0] -> labels[0], ..., else labels[-1]."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cut points")
    expr = F.when(col(c) < cuts[0], F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(col(c) < cut, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def duration_band(c) -> Column:
    return band(c, DURATION_CUTS, DURATION_LABELS)


def energy_band(c) -> Column:
    return band(c, ENERGY_CUTS, ENERGY_LABELS)


def band_order(c, labels: Sequence[str]) -> Column:
    """1-based numeric position of a band label (0 when unknown)."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), col(c)).cast("int")


# --- P11: label fallback -----------------------------------------------------------
def station_label(name, station_id) -> Column:
    return F.coalesce(col(name), F.concat(F.lit(STATION_LABEL_PREFIX), col(station_id)))


# --- P13: SOC band -------------------------------------------------------------------
def soc_band(c) -> Column:
    return F.floor(col(c) / 10) * 10


# --- P16 / P17: ratio target and its inverse ------------------------------------------
def _known(x: Column) -> Column:
    """The value, or NULL for NaN, so that no comparison skips or promotes it."""
    return F.when(~F.isnan(x), x)


def log_ratio(y, anchor, floor: float = LOG_RATIO_FLOOR) -> Column:
    """log(max(y/anchor, floor)); NULL when either is NULL or NaN, or the anchor is 0."""
    ratio = _known(F.try_divide(col(y).cast("double"), col(anchor)))
    return F.when(ratio.isNotNull(), F.log(F.greatest(ratio, F.lit(floor))))


def clip_ratio(r) -> Column:
    """The ratio held within its bounds; NULL when it is NULL or NaN."""
    x = _known(col(r))
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(RATIO_MIN)), F.lit(RATIO_MAX)))


def ratio_inverse(z, anchor, log_target: bool = True) -> Column:
    """anchor * clip(exp(z), 0, 3) for a log target, anchor * clip(z, 0, 3) otherwise; NULL for NULL or NaN."""
    r = F.exp(col(z)) if log_target else col(z)
    return _known(col(anchor) * clip_ratio(r))


# --- P18: calendar features ---------------------------------------------------------------
def dow0(d) -> Column:
    """Monday=0 ... Sunday=6."""
    return F.weekday(col(d))


def calendar_feature_columns(d) -> list[Column]:
    dow = dow0(d)
    cols = [dow.alias("dow"), (dow >= 5).cast("int").alias("is_weekend"), F.month(col(d)).alias("month")]
    cols += [(dow == k).cast("int").alias(f"dow_{k}") for k in range(7)]
    return cols


# --- P19: rounding --------------------------------------------------------------------
def round_half_up(c, digits: int) -> Column:
    """Plain rounding, ties away from zero; the value itself is never moved."""
    return F.round(col(c), digits)


# --- F9: finiteness ------------------------------------------------------------------------
def is_nonfinite(c) -> Column:
    x = col(c)
    return F.isnan(x) | (x == float("inf")) | (x == float("-inf"))


# --- A18: error terms ---------------------------------------------------------------------
def abs_error(y, p) -> Column:
    return F.abs(col(y) - col(p))


def smape_term(y, p) -> Column:
    return 2 * F.abs(col(y) - col(p)) / (F.abs(col(y)) + F.abs(col(p)) + F.lit(SMAPE_EPS))
