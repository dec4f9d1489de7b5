"""Matcher settings."""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Setting(NamedTuple):
    """How far back a payment looks, and how far off a single match may be."""

    scenario: str
    days_window: int
    tolerance: Decimal


Settings = list[Setting] | DataFrame  # as a table: scenario, days_window, tolerance_amount

# The default setting and the four named presets.
DEFAULT = Setting("active", 60, Decimal("50.00"))
PRESETS = [
    Setting("03a", 60, Decimal("50.00")),
    Setting("03b", 60, Decimal("100.00")),
    Setting("03c", 120, Decimal("50.00")),
    Setting("03d", 120, Decimal("100.00")),
]


def active_settings(stored: DataFrame) -> list[Setting]:
    """The stored configuration row with id 1, or nothing if there is none.

    The global aggregate makes this one row however the table is filled.
    """
    row = (
        stored.where("id = 1")
        .agg(
            F.max("days_window").alias("days"),
            F.max(F.col("tolerance_amount").cast("decimal(18,2)")).alias("tolerance"),
        )
        .first()
    )
    return [] if row.days is None else [Setting("active", row.days, row.tolerance)]


def active_relation(stored: DataFrame) -> DataFrame:
    """The stored configuration row with id 1 as a table of settings, without reading it: one row or none."""
    return (
        stored.where("id = 1")
        .agg(F.max("days_window").cast("int").alias("days_window"),
             F.max(F.col("tolerance_amount").cast("decimal(18,2)")).alias("tolerance_amount"))
        .where("days_window IS NOT NULL")
        .select(F.lit("active").alias("scenario"), "days_window", "tolerance_amount")
    )


def config_table(spark: SparkSession, settings: list[Setting]) -> DataFrame:
    """Settings as a table."""
    rows = [
        F.struct(
            F.lit(s.scenario).alias("scenario"),
            F.lit(s.days_window).alias("days_window"),
            F.lit(s.tolerance).cast("decimal(18,2)").alias("tolerance_amount"),
        )
        for s in settings
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
