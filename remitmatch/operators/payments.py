"""Payments that name their invoice: matching, over- and underpayment, allocations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.functions.amounts import balance


BILLED = ["customer_id", "total_amount", "due_date"]


def latest_by_id(
    invoices: DataFrame, load_order: str | None = None, values: list[str] | None = None
) -> DataFrame:
    """One invoice per id: the last by ``load_order`` (or by order date where there is none).

    Of equally late ones the largest by ``values`` is kept, so the answer does not depend on the
    order in which rows arrive. Only ``values`` (what a match needs) are carried.
    """
    kept = F.struct(F.col(load_order or "order_date").alias("late"), *(values or BILLED))
    return invoices.groupBy("invoice_id").agg(F.max(kept).alias("kept")).select(
        "invoice_id", *[f"kept.{c}" for c in values or BILLED])


def match_by_reference(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Each payment with the invoice it names; customer and due date are the invoice's.

    Payments that name no known invoice drop out (see ``orphan_payments``). ``invoices``
    holds one row per id.
    """
    billed = invoices.selectExpr(
        "invoice_id", "customer_id", "total_amount AS invoice_total", "due_date AS invoice_due_date"
    )
    return (
        payments.select("payment_id", "invoice_id", "amount_paid", "payment_date")
        .join(billed, "invoice_id")
        .selectExpr(
            "payment_id", "invoice_id", "customer_id", "invoice_total", "amount_paid",
            "payment_date", "invoice_due_date",
            f"{balance('invoice_total', 'amount_paid')} AS balance_after_payment",
            "amount_paid >= invoice_total AS is_fully_paid",
        )
    )


def overpayments(matches: DataFrame) -> DataFrame:
    """Single payments above their invoice's total."""
    return matches.where("amount_paid > invoice_total").selectExpr(
        "payment_id", "invoice_id", "customer_id", "invoice_total", "amount_paid",
        "CAST(amount_paid - invoice_total AS DECIMAL(28,2)) AS overpayment_amount",
    )


def underpayments(matches: DataFrame) -> DataFrame:
    """Single payments below their invoice's total; instalments are not added up."""
    return matches.where("amount_paid < invoice_total").selectExpr(
        "payment_id", "invoice_id", "customer_id", "invoice_total", "amount_paid",
        "CAST(invoice_total - amount_paid AS DECIMAL(28,2)) AS outstanding_balance",
    )


def payment_allocations(payments: DataFrame, allocations: DataFrame) -> DataFrame:
    """Allocated and unallocated part of every payment."""
    allocated = allocations.groupBy("payment_id").agg(
        F.sum("allocated_amount").alias("total_allocated")
    )
    return (
        payments.select("payment_id", "amount_paid")
        .join(allocated, "payment_id", "left")
        .selectExpr(
            "payment_id", "amount_paid",
            "coalesce(total_allocated, 0.00) AS total_allocated",
        )
        .selectExpr("*", f"{balance('amount_paid', 'total_allocated')} AS unallocated_amount")
    )


def payment_flags(payments: DataFrame) -> DataFrame:
    return payments.selectExpr("payment_id", "status", "status = 'PARTIAL' AS is_partial")


def orphan_payments(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Payments that name an unknown invoice."""
    return payments.select("payment_id", "invoice_id").join(
        invoices.select("invoice_id"), "invoice_id", "left_anti"
    )


def orphan_returns(returns: DataFrame, invoices: DataFrame) -> DataFrame:
    """Returns that name an unknown invoice."""
    known = invoices.select(F.col("invoice_id").alias("original_invoice_id"))
    return returns.select("return_id", "original_invoice_id").join(
        known, "original_invoice_id", "left_anti"
    )
