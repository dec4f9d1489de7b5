"""Raw CSV prefixes as tables of Spark's catalogue, with partitions found by looking.

A prefix holds one folder per date, ``<prefix>/2024-01-01/`` or ``<prefix>/run_date=2024-01-01/``. Its table is
external, all text and partitioned by ``run_date``. ``recover`` compares the date folders with the
partitions the catalogue knows: new folders become partitions, partitions whose folder is gone are
dropped (their files are not touched), and partitions take their layout from the table. Queries that filter on
``run_date`` then list and read the folders of those dates only.

What passes through the driver is one entry per date and entity, as in any partition listing. Folders
whose name is no date are left out, and files directly under the prefix belong to no partition. A date's
files lie in its folder, or all in one folder of parts inside it (``<date>/payments.csv/part-...``).
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession

from remitmatch.schemas import DOCUMENT_CSV, FLAT
from remitmatch.sources.documents import csv_options

_DATE_FOLDER = re.compile(r"(?:run_date=)?(\d{4}-\d{2}-\d{2})")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession, name: str, columns: list[str], location: str, multiline: bool = True,
    partitioned: bool = True,
) -> str:
    """An external all-text CSV table over ``location``; the same name again is left as it is.

    Its columns are those of the files' header, in order. Another header is an error when it is read.
    """
    layout = ", ".join(f"`{c}` STRING" for c in columns)
    by_date = "PARTITIONED BY (run_date)" if partitioned else ""
    options = ", ".join(f"{_quoted(k)} {_quoted(v)}" for k, v in csv_options(multiline).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({layout}{', run_date DATE' if partitioned else ''}) "
        f"USING csv OPTIONS ({options}) {by_date} LOCATION {_quoted(location)}")
    return name


def date_folders(spark: SparkSession, location: str) -> dict[datetime.date, str]:
    """The date folders under a prefix that hold anything, with their paths; none if there is no prefix."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in files.listStatus(path) if files.exists(path) else []:
        name = _DATE_FOLDER.fullmatch(status.getPath().getName())
        if not name or not status.isDirectory():
            continue
        try:
            day = datetime.date.fromisoformat(name.group(1))
        except ValueError:
            continue
        inside = [s for s in files.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
        parts = [s for s in inside if s.isDirectory()]
        if not inside:
            continue
        if day in found or len(parts) > 1 or len(parts) not in (0, len(inside)):
            raise ValueError(f"{location}: the files of {day} lie in more than one folder")
        found[day] = (parts or [status])[0].getPath().toString()
    return found


def partitions(spark: SparkSession, name: str) -> set[datetime.date]:
    """The dates the catalogue knows of a table."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {datetime.date.fromisoformat(r.partition.split("=", 1)[1]) for r in rows}


def recover(spark: SparkSession, name: str, location: str) -> tuple[list[datetime.date], list[datetime.date]]:
    """Bring the partitions in line with the folders; returns the dates (added, dropped)."""
    folders, known = date_folders(spark, location), partitions(spark, name)
    added, dropped = sorted(folders.keys() - known), sorted(known - folders.keys())
    for start in range(0, len(added), 100):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION (run_date = DATE'{d}') LOCATION {_quoted(folders[d])}" for d in added[start : start + 100]))
    for start in range(0, len(dropped), 100):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(
            f"PARTITION (run_date = DATE'{d}')" for d in dropped[start : start + 100]))
    spark.catalog.refreshTable(name)
    return added, dropped


def crawl(
    spark: SparkSession, root: str, database: str, prefixes: dict[str, str] | None = None, multiline: bool = True
) -> dict[str, tuple[list[datetime.date], list[datetime.date]]]:
    """Make or bring up to date the tables of all document prefixes under ``root``.

    ``prefixes`` gives the folder of an entity where it is not called like the entity. Running it again after
    new dates have come is all that a schedule has to do.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    changes = {}
    for entity, layout in DOCUMENT_CSV.items():
        location = f"{root}/{(prefixes or {}).get(entity, entity).strip('/')}"
        name = create_table(spark, f"{database}.{entity}", layout.fieldNames(), location, multiline)
        changes[entity] = recover(spark, name, location)
    return changes


def flat_prefixes(spark: SparkSession, root: str, database: str, multiline: bool = True) -> None:
    """The five flat tables over ``root/<table>/`` as unpartitioned tables of the catalogue."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, layout in FLAT.items():
        create_table(spark, f"{database}.{name}", list(layout), f"{root}/{name}", multiline, partitioned=False)


def known_partitions(spark: SparkSession, database: str) -> DataFrame:
    """``table_name, run_date`` of every partition the catalogue knows of the document tables."""
    rows = [(entity, day) for entity in DOCUMENT_CSV for day in sorted(partitions(spark, f"{database}.{entity}"))]
    return spark.createDataFrame(rows, "table_name string, run_date date")
