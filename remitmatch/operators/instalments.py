"""Partial payment analysis in the warehouse reading."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.functions.amounts import as_of_sql, pct_paid
from remitmatch.operators.aging import COUNTED
from remitmatch.operators.ledger import ranged


def payment_sums(payments: DataFrame) -> DataFrame:
    """Cleared and partial payments per invoice."""
    return (
        payments.where(COUNTED)
        .groupBy("invoice_id")
        .agg(
            F.expr("sum(amount_paid) AS total_amount_paid"),
            F.expr("count(*) AS payment_count"),
            F.expr("min(payment_date) AS first_payment_date"),
            F.expr("max(payment_date) AS last_payment_date"),
        )
    )


def payment_classification(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Every non-void invoice with what was paid on it. UNPAID is tested first."""
    return (
        invoices.where("status <> 'VOID'")
        .selectExpr(
            "invoice_id", "customer_id", "order_date", "due_date", "total_amount", "currency",
            "status AS invoice_status",
        )
        .join(payment_sums(payments), "invoice_id", "left")
        .selectExpr(
            "invoice_id", "customer_id", "order_date", "due_date", "total_amount", "currency",
            "invoice_status",
            "coalesce(total_amount_paid, 0.00) AS total_amount_paid",
            "coalesce(payment_count, 0) AS payment_count",
            "first_payment_date", "last_payment_date",
        )
        .selectExpr(
            "*",
            "CAST(total_amount - total_amount_paid AS DECIMAL(28,2)) AS outstanding_balance",
            """CASE WHEN total_amount_paid = 0 THEN 'UNPAID'
                    WHEN total_amount_paid >= total_amount THEN 'FULLY_PAID'
                    ELSE 'PARTIALLY_PAID' END AS payment_classification""",
        )
    )


def partial_payment_analysis(
    invoices: DataFrame, payments: DataFrame, as_of: datetime.date | None = None
) -> DataFrame:
    """Classification plus days overdue and percentage paid."""
    today = as_of_sql(as_of)
    return payment_classification(invoices, payments).selectExpr(
        "invoice_id", "customer_id", "order_date", "due_date", "total_amount", "currency",
        "invoice_status", "total_amount_paid", "outstanding_balance", "payment_count",
        "first_payment_date", "last_payment_date", "payment_classification",
        f"""CASE WHEN due_date IS NOT NULL AND outstanding_balance > 0 AND due_date < {today}
            THEN datediff({today}, due_date) ELSE 0 END AS days_overdue""",
        f"{pct_paid('total_amount_paid', 'total_amount')} AS pct_paid",
    )


def running_payments(
    invoices: DataFrame, payments: DataFrame, parts: int | None = None
) -> DataFrame:
    """Each counted payment of a partly paid invoice with the total paid up to it.

    The order is payment date, then payment id. Payments are range-partitioned by invoice, date and
    id (written once, see ``ledger``); the running total is summed inside the part of an invoice that one
    partition holds, and the sums of the parts before it are added. So an invoice with very many
    payments is spread over many tasks, whatever its ids look like.
    """
    run = ["invoice_id", "chunk"]
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    counted = ranged(
        payments.where(COUNTED).select(
            "invoice_id", "payment_date", "payment_id", "amount_paid", "payment_method",
            "reference_number"),
        ["invoice_id", "payment_date", "payment_id"], parts)
    partly = (
        payment_classification(invoices, payments)
        .where("payment_classification = 'PARTIALLY_PAID'")
        .select(
            "invoice_id", "customer_id", "total_amount", "total_amount_paid",
            "outstanding_balance", "payment_count", "payment_classification",
        )
    )
    before = counted.groupBy(*run).agg(F.expr("sum(amount_paid) AS paid")).selectExpr(
        *run,
        f"coalesce(sum(paid) OVER (PARTITION BY invoice_id ORDER BY chunk {earlier}), 0) AS paid_before",
    )
    return (
        counted.selectExpr(
            "*",
            """sum(amount_paid) OVER (PARTITION BY invoice_id, chunk ORDER BY payment_date, payment_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS paid_in_run""",
        )
        .join(before, run)
        .join(partly, "invoice_id")
        .selectExpr(
            "invoice_id", "customer_id", "total_amount", "total_amount_paid",
            "outstanding_balance", "payment_count", "payment_classification", "payment_id",
            "payment_date", "amount_paid AS individual_payment_amount", "payment_method",
            "reference_number",
            "CAST(paid_before + paid_in_run AS DECIMAL(28,2)) AS running_total_paid",
        )
    )
