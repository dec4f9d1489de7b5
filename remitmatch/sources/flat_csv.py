"""The five flat tables from CSV: typed loads and all-text tables over prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from remitmatch.functions.parsing import amount, date, whole
from remitmatch.schemas import FLAT
from remitmatch.sources.documents import read_csv_text

CASTS = {"bigint": whole, "date": date, "decimal(18,2)": amount, "string": str}


def load_flat(spark: SparkSession, table: str, path: str, multiline: bool = True) -> DataFrame:
    """One flat table, columns taken by header name.

    Columns the header lacks are NULL; a header with unknown columns, or none, is an error.
    """
    text = read_csv_text(spark, path, multiline)
    layout = FLAT[table]
    unknown = sorted(set(text.columns) - set(layout))
    if unknown or not text.columns:
        raise ValueError(f"{path}: unexpected header {text.columns} for {table}")
    return text.selectExpr(
        *[
            f"{CASTS[kind](name)} AS {name}" if name in text.columns
            else f"CAST(NULL AS {kind}) AS {name}"
            for name, kind in layout.items()
        ]
    )


def load_flat_tables(spark: SparkSession, root: str, multiline: bool = True) -> dict[str, DataFrame]:
    """All five tables from ``root/<table>.csv``."""
    return {name: load_flat(spark, name, f"{root}/{name}.csv", multiline) for name in FLAT}


def external_tables(spark: SparkSession, root: str, multiline: bool = True) -> dict[str, DataFrame]:
    """All-text views over the CSV prefixes ``root/<table>/``, registered by table name."""
    tables = {}
    for name in FLAT:
        tables[name] = read_csv_text(spark, f"{root}/{name}/", multiline)
        tables[name].createOrReplaceTempView(name)
    return tables
