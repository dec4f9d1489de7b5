"""Declared constraints over any number of tables, settled together.

Every table is read twice: once for its keys, once for everything a row breaks by itself (NOT NULL, CHECK) and
for its references. All keys of all tables are counted in one exchange; the references go through one
more and keep those that meet no key. Rows with a broken rule of their own ride along with the references
under a key that nothing has, so no rule adds a pass or an exchange, and many rows with one
missing parent can be split like any join.

As in SQL, a check that comes out NULL holds, a reference with a NULL in it is not looked up, and a key with a
NULL in it is no key; its columns count as NOT NULL. Columns that a table lacks are not checked, nor are
references to tables that are not given.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FOUND = "array<struct<constraint_name:string,domain:string,key:array<string>>>"
# A number that keys are sorted by before they are compared: the names of tables all begin alike.
_PLACE = "hash(domain, key) AS place"


class Rules(NamedTuple):
    """What holds for one table. ``row_key`` names a row in the report (default: its key)."""

    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    checks: Mapping[str, str] = {}
    references: tuple[tuple[str, tuple[str, ...], str], ...] = ()  # rule, columns, parent table
    row_key: tuple[str, ...] = ()


def _texts(columns: tuple[str, ...]) -> str:
    return f"array({', '.join(f'CAST({c} AS STRING)' for c in columns)})"


def _present(columns: tuple[str, ...]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def _row_findings(name: str, df: DataFrame, rules: Rules, tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Broken rules of single rows (``domain`` NULL) and references to look up, one pass over the table."""
    named = rules.row_key or rules.key
    own = f"array_join({_texts(named)}, '|')"

    def broken(rule: str, test: str) -> str:
        return f"CASE WHEN NOT ({test}) THEN struct('{rule}' AS constraint_name, NULL AS domain, array({own}) AS key) END"

    def looked_up(rule: str, columns: tuple[str, ...], parent: str) -> str:
        return (f"CASE WHEN {_present(columns)} THEN struct('{rule}' AS constraint_name, '{parent}' AS domain, "
                f"{_texts(columns)} AS key) END")

    needed = [c for c in dict.fromkeys([*rules.key, *rules.not_null]) if c in df.columns]
    found = [broken(f"nn_{name}_{c}", f"{c} IS NOT NULL") for c in needed]
    found += [broken(rule, test) for rule, test in rules.checks.items()]
    found += [looked_up(rule, columns, parent) for rule, columns, parent in rules.references
              if parent in tables and set(columns) <= set(df.columns)]
    if not found:
        return None
    return df.selectExpr(
        f"'{name}' AS table_name", f"{own} AS row_key",
        f"inline(array_compact(CAST(array({', '.join(found)}) AS {_FOUND})))").selectExpr("*", _PLACE)


def _keys(name: str, df: DataFrame, rules: Rules) -> DataFrame | None:
    if not rules.key or not set(rules.key) <= set(df.columns):
        return None
    return df.where(_present(rules.key)).selectExpr(
        f"'{name}' AS domain", f"{_texts(rules.key)} AS key").selectExpr("*", _PLACE)


def violations(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """``table_name, constraint_name, row_key`` of every broken constraint; a repeated key once."""
    union = lambda parts: reduce(DataFrame.unionByName, [p for p in parts if p is not None])
    counted = union(_keys(n, df, rules[n]) for n, df in tables.items()).groupBy("place", "domain", "key").agg(
        F.count("*").alias("n"))
    findings = union(_row_findings(n, df, rules[n], tables) for n, df in tables.items())
    # an anti-join would be pushed into the union, and the keys sorted again for every table
    known = counted.selectExpr("place", "domain", "key", "true AS known")
    repeated = counted.where("n > 1").selectExpr(
        "domain AS table_name", "concat('pk_', domain) AS constraint_name", "array_join(key, '|') AS row_key")
    return findings.join(known, ["place", "domain", "key"], "left").where("known IS NULL").select(
        "table_name", "constraint_name", "row_key").unionByName(repeated)
