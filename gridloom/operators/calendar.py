"""Work calendar (J2, P18): a sparse table of exceptions to "weekends rest".

The reference looks dates up one by one in a holiday library; here the
calendar is a small table generated in Spark from rules and joined to the
series. Outside the listed exceptions the weekend rule applies, which gives
the same answer inside and outside the covered years.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import columns as C
from gridloom.operators.joins import join_dimension


def calendar_from_years(years: DataFrame, holidays: Sequence[tuple], makeup: Sequence[tuple]) -> DataFrame:
    """``cal_date, is_workday, holiday_name`` for every year in ``years`` (column ``year``).

    Holidays and make-up workdays are one rule array, exploded in a single
    pass over ``years``; a make-up day is listed only when it falls on a weekend.
    """
    rules = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(False).alias("work"),
                               F.lit(n).alias("name")) for m, d, n in holidays],
                    *[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(True).alias("work"),
                               F.lit(None).cast("string").alias("name")) for m, d in makeup])
    days = years.select(F.explode(rules).alias("r"), F.make_date("year", "r.m", "r.d").alias("cal_date"))
    return (days.filter(~F.col("r.work") | (C.dow0("cal_date") >= 5))
            .select("cal_date", F.col("r.work").alias("is_workday"), F.col("r.name").alias("holiday_name")))


def calendar_for(series: DataFrame, holidays: Sequence[tuple], makeup: Sequence[tuple],
                 date_col: str = "stat_date", horizon_days: int = 366) -> DataFrame:
    """Calendar of every year from the first day to ``horizon_days`` after the last one."""
    yr = series.agg(F.year(F.min(date_col)).alias("y0"),
                    F.year(F.date_add(F.max(date_col), horizon_days)).alias("y1"))
    years = yr.select(F.explode(F.sequence("y0", "y1")).alias("year"))
    return calendar_from_years(years, holidays, makeup)


def with_calendar(df: DataFrame, calendar: DataFrame, date_col: str = "stat_date") -> DataFrame:
    """Adds ``is_rest, is_holiday, is_makeup`` (0/1) by a left join to the calendar.

    Raises when it runs over a calendar that lists a date twice, which would repeat that day.
    """
    once = F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit("calendar: listed more than once: "), F.col("cal_date").cast("string")))).otherwise(F.lit(True))
    cal = (calendar.groupBy("cal_date")
           .agg(F.count(F.lit(1)).alias("_n"), F.bool_and("is_workday").alias("is_workday"),
                F.max("holiday_name").alias("holiday_name"))
           .select(F.col("cal_date").alias(date_col), "is_workday", "holiday_name", once.alias("_listed")))
    j = join_dimension(df, cal, date_col, "left")
    listed = F.coalesce(F.col("_listed"), F.lit(False))
    weekend = C.dow0(date_col) >= 5
    return j.select(
        *df.columns,
        F.when(listed, ~F.col("is_workday")).otherwise(weekend).cast("int").alias("is_rest"),
        (listed & ~F.col("is_workday") & F.col("holiday_name").isNotNull()).cast("int").alias("is_holiday"),
        (listed & F.col("is_workday") & weekend).cast("int").alias("is_makeup"))
