"""Daily drops: ``<prefix>/<entity>/<run date>/<entity>.csv``."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from remitmatch.sources.documents import read_csv_text

# The folder right above ``<entity>.csv`` (a file, or a folder of parts); NULL where that is no date.
RUN_DATE = r"""try_cast(regexp_extract(_metadata.file_path, '/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+[.]csv(/[^/]*)?$', 1) AS DATE)"""


def drop_path(root: str, entity: str, run_date: datetime.date | str, prefix: str | None = None) -> str:
    """Where one entity's file of one date lies; the prefix may differ from the entity name."""
    return f"{root}/{(prefix or entity).strip('/')}/{run_date}/{entity}.csv"


def read_drops(
    spark: SparkSession,
    root: str,
    entity: str,
    run_dates: list[datetime.date | str],
    prefix: str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """The drops of the given dates as text, with their ``run_date``."""
    paths = [drop_path(root, entity, d, prefix) for d in run_dates]
    return read_csv_text(spark, paths, multiline).selectExpr("*", f"{RUN_DATE} AS run_date")
