"""Money, date and bucket expressions, as SQL text for ``selectExpr``."""

from __future__ import annotations

import datetime

# The two label sets of the aging buckets, in order.
DOCUMENT_BUCKETS = ["Current", "1-30", "31-60", "61-90", "90+"]
WAREHOUSE_BUCKETS = ["Current", "1-30 Days", "31-60 Days", "61-90 Days", "90+ Days"]
BUCKET_ENDS = [0, 30, 60, 90]


def as_of_sql(as_of: datetime.date | None) -> str:
    """The reporting date; today when none is given."""
    return "current_date()" if as_of is None else f"DATE'{as_of.isoformat()}'"


def bucket(days: str, names: list) -> str:
    """The aging bucket of a number of days past due."""
    arms = " ".join(
        f"WHEN {days} <= {end} THEN {_literal(name)}" for end, name in zip(BUCKET_ENDS, names)
    )
    return f"CASE {arms} ELSE {_literal(names[-1])} END"


def bucket_sort(days: str) -> str:
    """Position of the bucket, for ordering."""
    return bucket(days, list(range(len(BUCKET_ENDS) + 1)))


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def line_total(quantity: str = "quantity", price: str = "unit_price") -> str:
    """quantity * unit price, to four decimals."""
    return f"CAST({quantity} * {price} AS DECIMAL(28,4))"


def lines_total(items: str = "line_items") -> str:
    """Sum of the line totals of an array of lines."""
    return (
        f"aggregate({items}, CAST(0 AS DECIMAL(28,4)), "
        "(total, l) -> CAST(total + l.quantity * l.unit_price AS DECIMAL(28,4)))"
    )


def balance(total: str, paid: str) -> str:
    """What is left to pay, never below zero."""
    return f"CAST(greatest(0, {total} - {paid}) AS DECIMAL(28,2))"


def pct_paid(paid: str, total: str) -> str:
    """Percentage paid, rounded half up to two decimals in whole cents; 0 for a zero total."""
    hundredths = (
        f"((CAST({paid} AS DECIMAL(20,2)) * 2000000 + {total} * 100) div ({total} * 200))"
    )
    return f"CASE WHEN {total} > 0 THEN CAST({hundredths} / 100 AS DECIMAL(18,2)) ELSE 0.00 END"
