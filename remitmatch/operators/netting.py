"""What is still due on an invoice after credits and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.schemas import MONEY


def credits_by_invoice(credits: DataFrame) -> DataFrame:
    """Sum of applied credits per invoice; unapplied ones are dropped before the shuffle."""
    return (
        credits.where(F.col("applied_invoice_id").isNotNull())
        .groupBy(F.col("applied_invoice_id").alias("invoice_id"))
        .agg(F.sum("credit_amount").alias("credits_applied"))
    )


def returns_by_invoice(returns: DataFrame) -> DataFrame:
    """Sum of return credits per original invoice."""
    return (
        returns.where(F.col("original_invoice_id").isNotNull())
        .groupBy(F.col("original_invoice_id").alias("invoice_id"))
        .agg(F.sum("credit_amount").alias("returns_credit"))
    )


def invoice_net_due(invoices: DataFrame, credits: DataFrame, returns: DataFrame) -> DataFrame:
    """Invoices with credits, returns and net due.

    Both child tables are summed per invoice first, so the joins never fan out.
    """
    zero = F.lit(0).cast(MONEY)
    return (
        invoices.join(credits_by_invoice(credits), "invoice_id", "left")
        .join(returns_by_invoice(returns), "invoice_id", "left")
        .withColumns(
            {
                "credits_applied": F.coalesce("credits_applied", zero).cast(MONEY),
                "returns_credit": F.coalesce("returns_credit", zero).cast(MONEY),
            }
        )
        .withColumn(
            "invoice_net_due",
            (F.col("invoice_amount") - F.col("credits_applied") - F.col("returns_credit")).cast(
                MONEY
            ),
        )
        .select(
            "invoice_id", "customer_id", "invoice_date", "due_date", "invoice_amount",
            "credits_applied", "returns_credit", "invoice_net_due",
        )
    )
