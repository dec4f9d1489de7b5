"""The discrepancy list over all three kinds, and what is derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def discrepancy_report(mismatches: DataFrame, matches: DataFrame) -> DataFrame:
    """SKU mismatches, overpayments and underpayments as one list.

    Over- and underpayments come from one pass over the matches.
    """
    swapped = mismatches.selectExpr(
        "'SKU_MISMATCH' AS discrepancy_type",
        "return_id AS entity_id", "customer_id", "original_invoice_id AS reference_id",
        "CAST(line_value AS DECIMAL(28,4)) AS amount",
        "concat(original_sku, ' -> ', returned_sku) AS detail",
        "classification",
    )
    kind = "CASE WHEN amount_paid > invoice_total THEN 'OVERPAYMENT' ELSE 'UNDERPAYMENT' END"
    off = matches.where("amount_paid <> invoice_total").selectExpr(
        f"{kind} AS discrepancy_type",
        "payment_id AS entity_id", "customer_id", "invoice_id AS reference_id",
        "CAST(abs(amount_paid - invoice_total) AS DECIMAL(28,4)) AS amount",
        "concat('paid ', CAST(amount_paid AS DECIMAL(28,2)), ' vs invoiced ',"
        " CAST(invoice_total AS DECIMAL(28,2))) AS detail",
        f"{kind} AS classification",
    )
    return swapped.unionByName(off)


def discrepancy_totals(report: DataFrame) -> DataFrame:
    """One row of counts and sums over the list."""
    def count(kind: str, name: str):
        return F.expr(f"count_if(discrepancy_type = '{kind}') AS {name}")

    def total(kind: str, name: str):
        return F.expr(
            f"coalesce(sum(CASE WHEN discrepancy_type = '{kind}' THEN amount END), 0) AS {name}"
        )

    return report.agg(
        count("SKU_MISMATCH", "sku_mismatches"),
        count("OVERPAYMENT", "overpayments"),
        count("UNDERPAYMENT", "underpayments"),
        F.expr("count_if(classification = 'FRAUD') AS fraud_alerts"),
        total("OVERPAYMENT", "total_overpayment_amount"),
        total("UNDERPAYMENT", "total_outstanding_amount"),
        F.expr("count(*) > 0 AS has_discrepancies"),
    )


def high_risk_accounts(report: DataFrame) -> DataFrame:
    """Customers with at least two kinds of discrepancy.

    Three flags per customer are combined map-side; nothing is collected or made distinct.
    """
    kinds = ["SKU_MISMATCH", "OVERPAYMENT", "UNDERPAYMENT"]
    found = [F.expr(f"max(CAST(discrepancy_type = '{k}' AS INT)) AS {k.lower()}") for k in kinds]
    return (
        report.groupBy("customer_id")
        .agg(*found)
        .selectExpr("customer_id", " + ".join(k.lower() for k in kinds) + " AS discrepancy_types")
        .where("discrepancy_types >= 2")
    )
