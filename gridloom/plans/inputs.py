"""Lazily built layer DataFrames over one fixture directory.

Nothing here runs a job: every property is a logical plan, so each query only
reads the columns and rows its own result needs.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from gridloom.operators import sessions as S
from gridloom.operators import telemetry as B
from gridloom.sources import fixtures as X


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return X.table(self.spark, self.sf_dir, name)

    # --- sessions -----------------------------------------------------------
    @cached_property
    def raw_sessions(self) -> DataFrame:
        return X.raw_sessions(self.table("events"))

    @cached_property
    def typed(self) -> DataFrame:
        return S.type_sessions(self.raw_sessions, X.FIXTURE_CENTURY_YEARS)

    @cached_property
    def classified(self) -> DataFrame:
        return S.classify(self.typed)

    @cached_property
    def accepted_rows(self) -> DataFrame:
        return S.accepted(self.classified)

    @cached_property
    def clean(self) -> DataFrame:
        return S.dedup_accepted(self.classified, list(S.RAW_SESSION_COLUMNS), X.FIXTURE_CENTURY_YEARS)

    @cached_property
    def raw_stations(self) -> DataFrame:
        return X.raw_stations(self.table("customer"))

    @cached_property
    def stations(self) -> DataFrame:
        return S.dedup_stations(self.raw_stations)

    @cached_property
    def dwd(self) -> DataFrame:
        return S.enrich(self.clean, self.stations)

    # --- telemetry ------------------------------------------------------------
    @cached_property
    def raw_battery(self) -> DataFrame:
        return X.raw_battery(self.table("lineitem"))

    @cached_property
    def battery(self) -> DataFrame:
        return B.clean_battery(B.type_battery(self.raw_battery))

    @cached_property
    def battery_flagged(self) -> DataFrame:
        """Typed telemetry with ``is_valid`` (one row per source row)."""
        return B.classify_battery(B.type_battery(self.raw_battery))

    # --- load series input ------------------------------------------------------
    @cached_property
    def order_sessions(self) -> DataFrame:
        return X.order_sessions(self.table("orders"))
