"""Invoice, payment and return documents from CSV.

A path may be a file, a folder, a pattern or a list of them, under any URI scheme that
Spark reads, so object stores need nothing of their own.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitmatch.functions.parsing import amount, date, parse_lines, quantity
from remitmatch.operators.validation import RULES, rejected, with_violations
from remitmatch.schemas import DOCUMENT_CSV, INVOICE_LINES_RAW, RETURN_LINES_RAW

LINE_LAYOUTS = {"invoices": INVOICE_LINES_RAW, "returns": RETURN_LINES_RAW}

# Cells that stand for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def csv_options(multiline: bool = True) -> dict[str, str]:
    """How this engine writes CSV and reads it back: cells may hold quotes, blanks, line breaks.

    With ``multiline`` a file is read by one task, as only a reader that saw all of it knows
    which line breaks stand in quotes. Drops and exports are many files, so the work still
    spreads; for one huge file without line breaks in its cells, turn it off.
    """
    return {
        "header": "true", "quote": '"', "escape": '"', "enforceSchema": "false",
        "multiLine": str(multiline).lower(), "lineSep": "\n",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }


def read_csv_text(spark: SparkSession, paths: str | list[str], multiline: bool = True) -> DataFrame:
    """CSV with a header, by column name, every cell a string.

    All files of a path must carry the same header; another one is an error, not a shift.
    """
    return spark.read.options(**csv_options(multiline)).csv(paths)


def arrange(raw: DataFrame, entity: str, extra: list[str] | None = None) -> DataFrame:
    """The entity's columns in order, missing cells as NULL.

    A missing column reads as NULL, except the currency, which then is USD throughout.
    """
    gaps = ", ".join(f"'{v}'" for v in MISSING)
    columns = []
    for name in DOCUMENT_CSV[entity].fieldNames():
        if name in raw.columns:
            columns.append(f"CASE WHEN {name} NOT IN ({gaps}) THEN {name} END AS {name}")
        else:
            columns.append(f"'USD' AS {name}" if name == "currency" else f"CAST(NULL AS STRING) AS {name}")
    return raw.selectExpr(*columns, *(extra or []))


def read_documents(raw: DataFrame, entity: str, extra: list[str] | None = None, literals: bool = True) -> DataFrame:
    """Text records with their lines parsed and their broken rules listed."""
    records = arrange(raw, entity, extra)
    if entity in LINE_LAYOUTS:
        records = parse_lines(records, LINE_LAYOUTS[entity], literals)
    return with_violations(records, RULES[entity])


TYPED = {
    "invoices": [
        "invoice_id", "customer_id", f"{date('order_date')} AS order_date",
        f"{date('due_date')} AS due_date",
        f"""transform(line_items, l -> named_struct(
              'sku', l.sku, 'description', l.description,
              'quantity', {quantity('l.quantity')},
              'unit_price', {amount('l.unit_price', 4)})) AS line_items""",
        f"{amount('total_amount')} AS total_amount",
        f"coalesce({amount('amount_paid')}, 0.00) AS amount_paid",
        "currency", "status", "notes",
    ],
    "payments": [
        "payment_id", "invoice_id", "customer_id", f"{date('payment_date')} AS payment_date",
        f"{amount('amount_paid')} AS amount_paid", "payment_method", "reference_number",
        "status", "notes",
    ],
    "returns": [
        "return_id", "original_invoice_id", "customer_id",
        f"{date('return_date')} AS return_date",
        f"""transform(line_items, l -> named_struct(
              'original_sku', l.original_sku, 'returned_sku', l.returned_sku,
              'quantity', {quantity('l.quantity')},
              'unit_price', {amount('l.unit_price', 4)}, 'notes', l.notes)) AS line_items""",
        "reason_code", "status", "credit_memo_id", "notes",
    ],
}


class Loaded(NamedTuple):
    """What came out of one source: all records, the typed good ones, the bad ones."""

    checked: DataFrame
    valid: DataFrame
    quarantine: DataFrame


def split(
    checked: DataFrame, entity: str, extra: list[str] | None = None, strict_dates: bool = False
) -> Loaded:
    """Good records typed, bad ones as text with the rules they break.

    A date that cannot be read is a broken rule and is reported, but the record stays, with
    NULL for the date; ``strict_dates`` sets such records aside too.
    """
    bad = rejected(strict_dates)
    return Loaded(
        checked,
        checked.where(f"NOT {bad}").selectExpr(*TYPED[entity], *(extra or [])),
        checked.where(bad),
    )


def scan(
    spark: SparkSession, entity: str, paths: str | list[str], literals: bool = True,
    strict_dates: bool = False, multiline: bool = True,
) -> Loaded:
    """Read, check and type one entity. Invoices keep their load order, for duplicates."""
    raw = read_csv_text(spark, paths, multiline)
    extra = []
    if entity == "invoices":
        raw = raw.select(
            "*",
            F.struct(
                "_metadata.file_path", "_metadata.file_block_start",
                F.monotonically_increasing_id().alias("row"),
            ).alias("load_order"),
        )
        extra = ["load_order"]
    return split(read_documents(raw, entity, extra, literals), entity, extra, strict_dates)
