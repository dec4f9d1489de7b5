"""From text to typed values: line items, amounts, quantities, dates."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitmatch.functions.plan import once


def amount(text: str, scale: int = 2) -> str:
    """A decimal, or NULL where the text is no number."""
    return f"try_cast({text} AS DECIMAL(18,{scale}))"


def whole(text: str) -> str:
    """A whole number; decimals are cut off, so 12.0 reads as 12."""
    return f"CAST(try_cast({text} AS DECIMAL(28,6)) AS BIGINT)"


def quantity(text: str) -> str:
    """A line's quantity as ``parse_lines`` leaves it, or NULL where it is no whole number."""
    return f"try_cast({text} AS INT)"


def date(text: str) -> str:
    """An ISO date, or NULL."""
    return f"CAST(try_to_timestamp({text}, 'yyyy-MM-dd') AS DATE)"


@F.pandas_udf(T.StringType())
def literal_to_json(texts: pd.Series) -> pd.Series:
    """Lists written as Python literals, rewritten as JSON; NULL for anything else."""

    def convert(text):
        if text is None:
            return None
        try:
            return json.dumps(ast.literal_eval(text.strip()))
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return texts.map(convert)


# A quantity that is no whole number as it stands: only its JSON type says how it reads.
_ODD = "exists(lines, l -> l.quantity IS NOT NULL AND try_cast(l.quantity AS INT) IS NULL)"
_TYPED = "from_json(source, 'array<struct<quantity variant>>')"


def _whole_quantities(layout: T.ArrayType) -> str:
    """The parsed ``lines`` with their quantities as whole numbers in text, by type.

    A number is cut towards zero (2.7 is 2) and a truth value counts as 1 or 0. A text stays as it is, so
    that "3" is a quantity and "2.7" is none. The types come from a second reading as VARIANT,
    which only lists with such a quantity need.
    """
    value = "get(typed, i).quantity"
    by_type = f"""CASE WHEN {value} IS NULL THEN l.quantity
        WHEN schema_of_variant({value}) = 'BOOLEAN'
            THEN CAST(CAST(try_variant_get({value}, '$', 'boolean') AS INT) AS STRING)
        WHEN schema_of_variant({value}) RLIKE '^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$'
            THEN CAST(try_cast(try_variant_get({value}, '$', 'decimal(38,6)') AS BIGINT) AS STRING)
        ELSE l.quantity END"""
    fields = ", ".join(
        f"'{f}', {by_type if f == 'quantity' else f'l.{f}'}" for f in layout.elementType.fieldNames())
    # the typed list is bound once, as the only element of an array
    return f"""CASE WHEN {_ODD} THEN
        transform(array({_TYPED}), typed -> transform(lines, (l, i) -> named_struct({fields})))[0] ELSE lines END"""


def parse_lines(
    df: DataFrame, layout: T.ArrayType, literals: bool = True, coerce: bool = True
) -> DataFrame:
    """``line_items`` text as an array of all-string lines; NULL where it cannot be read.

    JSON is read by Spark itself. Only text it cannot read goes through the Python-literal
    reader; for all other rows that column is NULL. ``literals=False`` leaves it out. Quantities
    become whole numbers by their type (``_whole_quantities``), unless ``coerce`` is off.
    """
    schema = layout.simpleString()

    def read(text: str) -> str:
        # from_json also takes a lone object and ignores what follows the list
        return f"CASE WHEN trim({text}) RLIKE r'(?s)^\\[.*\\]$' THEN from_json({text}, '{schema}') END"

    others = [c for c in df.columns if c != "line_items"]
    json_lines = once(df, [*others, "line_items"], read("line_items"), "as_json")
    if literals:
        unread = F.expr("CASE WHEN as_json IS NULL THEN line_items END")
        both = json_lines.withColumn("as_literal", literal_to_json(unread)).selectExpr(
            *others, "CASE WHEN as_json IS NULL THEN as_literal ELSE line_items END AS source", "as_json", "as_literal")
        lists = once(both, [*others, "source"], f"coalesce(as_json, {read('as_literal')})", "lines")
    else:
        lists = json_lines.selectExpr(*others, "line_items AS source", "as_json AS lines")
    if not coerce:
        return lists.selectExpr(*others, "lines AS line_items")
    return once(lists, others, _whole_quantities(layout), "line_items")
