"""SKU mismatches on returns: detection and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.functions.amounts import line_total

# When a mismatch is suspicious, and which prefixes may stand in for each other.
FRAUD_THRESHOLD = "500.00"
LOW_RISK_REASONS = ["WRONG_ITEM", "DEFECTIVE", "DAMAGED_IN_TRANSIT"]
SUBSTITUTES = {"SKU-PRMA": "SKU-PRMB", "SKU-PRMB": "SKU-PRMA"}


def fraud_test(
    value: str = "line_value", reason: str = "reason_code", threshold: str = FRAUD_THRESHOLD
) -> str:
    """High value and a reason that does not explain the swap."""
    reasons = ", ".join(f"'{r}'" for r in LOW_RISK_REASONS)
    return f"({value} >= {threshold} AND {reason} NOT IN ({reasons}))"


def classification(threshold: str = FRAUD_THRESHOLD, substitutes: dict[str, str] = SUBSTITUTES) -> str:
    """FRAUD before SUBSTITUTION before ERROR."""
    known = " OR ".join(
        f"(startswith(original_sku, '{old}') AND startswith(returned_sku, '{new}'))"
        for old, new in substitutes.items()
    )
    return (
        f"CASE WHEN {fraud_test(threshold=threshold)} THEN 'FRAUD' "
        f"WHEN {known or 'false'} THEN 'SUBSTITUTION' ELSE 'ERROR' END"
    )


def flag_returns(returns: DataFrame) -> DataFrame:
    """Per return: does any line come back as another SKU, how many, and what it is all worth."""
    return returns.selectExpr(
        "return_id", "customer_id",
        "exists(line_items, l -> l.original_sku <> l.returned_sku) AS has_sku_mismatch",
        "size(filter(line_items, l -> l.original_sku <> l.returned_sku)) AS mismatched_lines",
    )


def return_lines(returns: DataFrame, mismatched_only: bool = False) -> DataFrame:
    """One row per return line. Clean lines are dropped inside the array, before exploding."""
    items = "line_items"
    if mismatched_only:
        items = "filter(line_items, l -> l.original_sku <> l.returned_sku)"
    return returns.selectExpr(
        "return_id", "original_invoice_id", "customer_id", "return_date", "reason_code",
        f"explode({items}) AS line",
    ).selectExpr(
        "return_id", "original_invoice_id", "customer_id", "return_date",
        "line.original_sku", "line.returned_sku", "line.quantity", "line.unit_price",
        f"{line_total('line.quantity', 'line.unit_price')} AS line_value", "reason_code",
    )


def mismatch_report(returns: DataFrame) -> DataFrame:
    """Every mismatched return line with its class, whatever the return's status."""
    return return_lines(returns, mismatched_only=True).selectExpr(
        "*", f"{classification()} AS classification"
    )


def class_counts(mismatches: DataFrame) -> DataFrame:
    """Number of mismatches per class."""
    return mismatches.groupBy("classification").agg(F.count("*").alias("mismatches"))


def fraud_alerts(mismatches: DataFrame) -> DataFrame:
    return mismatches.where("classification = 'FRAUD'")


def sku_mismatch_detail(return_lines: DataFrame, returns: DataFrame, invoices: DataFrame) -> DataFrame:
    """Mismatched lines of returns that were not rejected and name a known invoice."""
    lines = return_lines.where("original_sku <> returned_sku").select(
        "return_id", "original_sku", "returned_sku", "quantity", "unit_price"
    )
    headers = returns.where("status NOT IN ('REJECTED')").selectExpr(
        "return_id", "original_invoice_id", "customer_id", "return_date", "reason_code",
        "status AS return_status",
    )
    context = invoices.selectExpr(
        "invoice_id AS original_invoice_id", "order_date AS original_order_date",
        "total_amount AS original_invoice_total", "currency",
    )
    return (
        lines.join(headers, "return_id")
        .join(context, "original_invoice_id")
        .selectExpr("*", f"{line_total()} AS line_value")
        .selectExpr(
            "return_id", "original_invoice_id", "customer_id", "return_date", "reason_code",
            "return_status", "original_sku", "returned_sku", "quantity", "unit_price",
            "line_value", "currency",
            f"{classification()} AS classification",
            f"{fraud_test()} AS is_fraud_alert",
            "original_order_date", "original_invoice_total",
            "datediff(return_date, original_order_date) AS days_to_return",
        )
    )
