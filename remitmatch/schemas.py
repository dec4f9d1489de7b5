"""Column layouts of every table, as Spark types.

CSV is always read as strings (``raw``) and cast with ``try_*`` functions, so one bad
cell never fails a job and types never depend on which files happen to be sampled.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)  # what Spark gives for sum(MONEY)
PRICE = T.DecimalType(18, 4)


def raw(*names: str) -> T.StructType:
    """An all-string layout."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# --- nested documents: invoices, payments and returns that name each other ----------

INVOICE_LINES_RAW = T.ArrayType(raw("sku", "description", "quantity", "unit_price"))
RETURN_LINES_RAW = T.ArrayType(
    raw("original_sku", "returned_sku", "quantity", "unit_price", "notes")
)

DOCUMENT_CSV = {
    "invoices": raw(
        "invoice_id", "customer_id", "order_date", "due_date", "line_items",
        "total_amount", "amount_paid", "currency", "status", "notes",
    ),
    "payments": raw(
        "payment_id", "invoice_id", "customer_id", "payment_date", "amount_paid",
        "payment_method", "reference_number", "status", "notes",
    ),
    "returns": raw(
        "return_id", "original_invoice_id", "customer_id", "return_date", "line_items",
        "reason_code", "status", "credit_memo_id", "notes",
    ),
}

# --- flat tables: a payment names only its customer ---------------------------------

FLAT = {
    "customers": {"customer_id": "bigint", "customer_name": "string", "industry": "string"},
    "invoices": {
        "invoice_id": "bigint", "customer_id": "bigint", "invoice_date": "date",
        "due_date": "date", "invoice_amount": "decimal(18,2)",
    },
    "payments": {
        "payment_id": "bigint", "customer_id": "bigint", "payment_amount": "decimal(18,2)",
        "payment_date": "date", "reference_notes": "string",
    },
    "returns": {
        "return_id": "bigint", "customer_id": "bigint", "original_invoice_id": "bigint",
        "return_sku": "string", "credit_amount": "decimal(18,2)",
    },
    "credits": {
        "credit_id": "bigint", "customer_id": "bigint", "credit_amount": "decimal(18,2)",
        "applied_invoice_id": "bigint",
    },
}

# --- result tables -------------------------------------------------------------------

RESULTS = {
    "result_id": "bigint", "pipeline_run_id": "string", "run_date": "date",
    "run_timestamp": "timestamp", "discrepancy_type": "string", "customer_id": "string",
    "entity_id": "string", "reference_id": "string", "discrepancy_amount": "decimal(18,2)",
    "detail": "string", "classification": "string", "is_fraud_alert": "boolean",
    "is_resolved": "boolean", "resolved_at": "timestamp", "resolved_by": "string",
    "resolution_notes": "string", "environment": "string", "created_at": "timestamp",
}

RUN_SUMMARY = {
    "pipeline_run_id": "string", "run_timestamp": "timestamp", "environment": "string",
    "invoices_processed": "bigint", "payments_processed": "bigint",
    "returns_processed": "bigint", "sku_mismatches_detected": "bigint",
    "overpayments_detected": "bigint", "underpayments_detected": "bigint",
    "fraud_alerts": "bigint", "high_risk_customers": "bigint", "pipeline_success": "boolean",
    "total_duration_seconds": "decimal(10,3)", "notes": "string",
}
