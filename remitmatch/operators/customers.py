"""Per-customer summaries and the risk report. Every summary is one partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _status_count(status: str, name: str):
    return F.expr(f"count_if(status = '{status}') AS {name}")


def customer_invoice_summary(invoices: DataFrame) -> DataFrame:
    return (
        invoices.where("status <> 'VOID'")
        .groupBy("customer_id")
        .agg(
            F.expr("count(*) AS total_invoices"),
            F.expr("sum(total_amount) AS total_invoiced"),
            F.expr("sum(amount_paid) AS total_collected"),
            F.expr("sum(total_amount) - sum(amount_paid) AS total_outstanding"),
            _status_count("PAID", "paid_invoices"),
            _status_count("PARTIAL", "partial_invoices"),
            _status_count("OPEN", "open_invoices"),
            _status_count("OVERDUE", "overdue_invoices"),
            F.expr("min(order_date) AS first_invoice_date"),
            F.expr("max(order_date) AS last_invoice_date"),
        )
    )


def customer_payment_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("customer_id").agg(
        F.expr("count(*) AS total_payments"),
        F.expr("sum(amount_paid) AS total_payments_amount"),
        _status_count("CLEARED", "cleared_payments"),
        _status_count("PARTIAL", "partial_payments"),
        _status_count("FAILED", "failed_payments"),
        F.expr("max(payment_date) AS last_payment_date"),
    )


def customer_returns_summary(returns: DataFrame) -> DataFrame:
    return returns.groupBy("customer_id").agg(
        F.expr("count(*) AS total_returns"),
        F.expr("count_if(sku_mismatch_flag) AS sku_mismatch_returns"),
        _status_count("REFUNDED", "refunded_returns"),
    )


def customer_discrepancies(results: DataFrame) -> DataFrame:
    """Unresolved discrepancies only."""
    kinds = {
        "SKU_MISMATCH": "sku_mismatches", "OVERPAYMENT": "overpayments",
        "UNDERPAYMENT": "underpayments",
    }
    return (
        results.where("NOT is_resolved")
        .groupBy("customer_id")
        .agg(
            F.expr("count(*) AS total_discrepancies"),
            *[F.expr(f"count_if(discrepancy_type = '{k}') AS {name}") for k, name in kinds.items()],
            F.expr("count_if(is_fraud_alert) AS fraud_alerts"),
            F.expr("sum(coalesce(discrepancy_amount, 0)) AS total_discrepancy_amount"),
        )
    )


def customer_risk_summary(
    invoices: DataFrame, payments: DataFrame, returns: DataFrame, results: DataFrame
) -> DataFrame:
    """One row per customer with a non-void invoice, with a risk score.

    A fraud alert is also a mismatch, so it weighs 13. All four summaries are keyed by
    customer, so the joins reuse the aggregations' partitioning and move no row twice.
    """
    def counted(*names: str) -> list[str]:
        return [f"coalesce({name}, 0) AS {name}" for name in names]

    open_items = customer_discrepancies(results).selectExpr(
        "customer_id", "total_discrepancies AS open_discrepancies",
        "sku_mismatches AS open_sku_mismatches", "overpayments AS open_overpayments",
        "underpayments AS open_underpayments", "fraud_alerts",
        "total_discrepancy_amount AS at_risk_amount",
    )
    return (
        customer_invoice_summary(invoices)
        .join(customer_payment_summary(payments), "customer_id", "left")
        .join(customer_returns_summary(returns), "customer_id", "left")
        .join(open_items, "customer_id", "left")
        .selectExpr(
            "customer_id", "total_invoices", "total_invoiced", "total_collected",
            "total_outstanding", "paid_invoices", "partial_invoices", "open_invoices",
            "overdue_invoices",
            *counted("total_payments", "cleared_payments", "partial_payments", "failed_payments"),
            "last_payment_date",
            *counted(
                "total_returns", "sku_mismatch_returns", "refunded_returns", "open_discrepancies",
                "open_sku_mismatches", "open_overpayments", "open_underpayments", "fraud_alerts",
                "at_risk_amount",
            ),
            """coalesce(fraud_alerts, 0) * 10 + coalesce(open_sku_mismatches, 0) * 3
               + overdue_invoices * 2 + coalesce(open_underpayments, 0) AS risk_score""",
            "first_invoice_date", "last_invoice_date",
        )
    )
