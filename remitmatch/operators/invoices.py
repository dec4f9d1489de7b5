"""Invoice balances and line totals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from remitmatch.functions.amounts import balance, line_total, lines_total


def invoice_balances(invoices: DataFrame) -> DataFrame:
    """Balance never below zero, the plain difference, and whether the invoice is overdue."""
    return invoices.selectExpr(
        "invoice_id", "total_amount", "amount_paid", "status",
        f"{balance('total_amount', 'amount_paid')} AS outstanding_balance",
        "CAST(total_amount - amount_paid AS DECIMAL(28,2)) AS unclamped_balance",
    ).selectExpr("*", "status = 'OVERDUE' AND outstanding_balance > 0 AS is_overdue")


def computed_totals(invoices: DataFrame) -> DataFrame:
    """Total of an invoice document as its lines add up."""
    return invoices.selectExpr(
        "invoice_id", "total_amount",
        f"coalesce({lines_total()}, 0) AS computed_total",
        "coalesce(size(line_items), 0) AS line_count",
    )


def return_values(returns: DataFrame) -> DataFrame:
    """Value of everything on a return document."""
    return returns.selectExpr(
        "return_id", f"coalesce({lines_total()}, 0) AS total_return_value"
    )


def line_totals(lines: DataFrame, key: str) -> DataFrame:
    return lines.selectExpr(key, "line_no", "quantity", "unit_price", f"{line_total()} AS line_total")
