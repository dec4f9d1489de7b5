"""Invoice numbers quoted in payment notes."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: how an invoice is quoted in free text.
INVOICE_QUOTE = r"(?i)\\bINV(\\d+)\\b"


def payment_invoice_links(payments: DataFrame) -> DataFrame:
    """Distinct (payment_id, invoice_id) quoted in the notes; numbers beyond BIGINT are left out."""
    quoted = f"regexp_extract_all(reference_notes, '{INVOICE_QUOTE}', 1)"
    return payments.selectExpr(
        "payment_id",
        f"""explode(array_distinct(array_compact(
            transform({quoted}, number -> try_cast(number AS BIGINT))))) AS invoice_id""",
    )
