"""All DuckDB statements by query name."""

from remitmatch.harness import oracle_documents, oracle_flat

ORACLE = {**oracle_flat.ORACLE, **oracle_documents.ORACLE}

# The reading order of each report, and the columns that show a row's place.
_DOCUMENT_BUCKETS = """CASE aging_bucket WHEN 'Current' THEN 0 WHEN '1-30' THEN 1 WHEN '31-60' THEN 2
                       WHEN '61-90' THEN 3 ELSE 4 END"""
_ORDER = {
    "aging_report": (f"{_DOCUMENT_BUCKETS}, customer_id, invoice_id", "aging_bucket, customer_id, invoice_id"),
    "aging_warehouse": (
        "aging_sort, customer_id, outstanding_balance DESC, invoice_id", "customer_id, invoice_id"),
    "mismatch_report": ("return_date, return_id, original_sku", "return_id, original_sku"),
    "sku_mismatch_detail": (
        "is_fraud_alert DESC, line_value DESC, return_date DESC, return_id, original_sku", "return_id, original_sku"),
    "discrepancy_report": (
        "discrepancy_type, customer_id, entity_id, detail", "discrepancy_type, customer_id, entity_id, detail"),
    "partial_payment_analysis": (
        "outstanding_balance DESC, customer_id, order_date, invoice_id", "customer_id, invoice_id"),
    "customer_risk_summary": ("risk_score DESC, total_outstanding DESC, customer_id", "customer_id"),
    "recon_dashboard": ("payment_count DESC, match_type", "match_type"),
    "high_risk_accounts": ("customer_id", "customer_id"),
}
ORACLE |= {
    f"{name}_order": f"SELECT {shown}, row_number() OVER (ORDER BY {order}) AS position FROM ({ORACLE[name]})"
    for name, (order, shown) in _ORDER.items()
}
