"""Record checks as one set-based pass: every rule is a column expression, none scans again."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.functions.parsing import amount, date, quantity
from remitmatch.functions.plan import kept_where, once
from remitmatch.operators.constraints import Rules
from remitmatch.operators.constraints import violations as violations_of

# Identifiers, codes and states that records may carry. \z rather than $,
# because $ also matches before a final line break.
INVOICE_ID = r"^INV-[0-9]{6,}\z"
PAYMENT_ID = r"^PMT-[0-9]{6,}\z"
RETURN_ID = r"^RET-[0-9]{6,}\z"
CUSTOMER_ID = r"^CUST-[0-9]{4,}\z"
SKU = r"^SKU-[A-Z0-9]{4,}\z"
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY"]
INVOICE_STATUSES = ["OPEN", "PARTIAL", "PAID", "OVERDUE", "VOID"]
PAYMENT_METHODS = ["ACH", "WIRE", "CHECK", "CREDIT_CARD", "DEBIT_CARD", "EFT", "CASH"]
PAYMENT_STATUSES = ["PENDING", "CLEARED", "FAILED", "REVERSED", "PARTIAL"]
RETURN_REASONS = [
    "DEFECTIVE", "WRONG_ITEM", "NOT_AS_DESCRIBED", "DUPLICATE_ORDER",
    "CUSTOMER_CHANGE_OF_MIND", "DAMAGED_IN_TRANSIT", "QUALITY_ISSUE", "OTHER",
]
RETURN_STATUSES = ["PENDING", "APPROVED", "REJECTED", "PROCESSED", "REFUNDED"]
KNOWN_CURRENCIES = [
    "USD", "EUR", "GBP", "CAD", "AUD", "NZD", "JPY", "CHF", "CNY", "HKD",
    "SGD", "SEK", "NOK", "DKK", "MXN", "BRL", "INR", "ZAR", "RUB", "KRW",
]

VIOLATION = "struct<rule:string,value:string>"
# Rules that are reported but set no record aside: an unreadable date is read as NULL.
DATE_RULES = ["order_date", "due_date", "payment_date", "return_date"]


@dataclass(frozen=True)
class Rule:
    """A named test that is true for bad records, and the value to report."""

    name: str
    fails: str
    value: str


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def matches(column: str, pattern: str) -> str:
    return f"coalesce({column} RLIKE r'{pattern}', false)"


def pattern_rule(column: str, pattern: str) -> Rule:
    return Rule(column, f"NOT {matches(column, pattern)}", column)


def code_rule(column: str, codes: list[str]) -> Rule:
    return Rule(column, f"NOT coalesce({column} IN ({_list(codes)}), false)", column)


def date_rule(column: str, optional: bool = False) -> Rule:
    missing = f"{column} IS NOT NULL AND " if optional else ""
    return Rule(column, f"{missing}{date(column)} IS NULL", column)


def line_rules(skus: list[str]) -> list[Rule]:
    """At least one line; every line with proper SKUs, quantity and price."""
    def some(test: str) -> str:
        return f"coalesce(exists(line_items, l -> {test}), false)"

    return [
        Rule("line_items", "coalesce(size(line_items), 0) < 1", "NULL"),
        *[
            Rule(
                f"line_items.{sku}",
                some(f"NOT {matches(f'l.{sku}', SKU)}"),
                f"filter(line_items, l -> NOT {matches(f'l.{sku}', SKU)})[0].{sku}",
            )
            for sku in skus
        ],
        Rule("line_items.quantity", some(f"coalesce({quantity('l.quantity')}, 0) < 1"), "NULL"),
        Rule(
            "line_items.unit_price",
            some(f"coalesce({amount('l.unit_price', 4)}, -1) < 0"),
            "NULL",
        ),
    ]


INVOICE_RULES = [
    pattern_rule("invoice_id", INVOICE_ID),
    pattern_rule("customer_id", CUSTOMER_ID),
    date_rule("order_date"),
    date_rule("due_date", optional=True),
    *line_rules(["sku"]),
    Rule("total_amount", f"coalesce({amount('total_amount')}, -1) < 0", "total_amount"),
    Rule(
        "amount_paid",
        f"amount_paid IS NOT NULL AND coalesce({amount('amount_paid')}, -1) < 0",
        "amount_paid",
    ),
    code_rule("currency", CURRENCIES),
    code_rule("status", INVOICE_STATUSES),
    Rule(
        "amount_paid_within_total",
        f"coalesce({amount('amount_paid')} > {amount('total_amount')}, false)"
        " AND coalesce(status, '') <> 'VOID'",
        "amount_paid",
    ),
]

PAYMENT_RULES = [
    pattern_rule("payment_id", PAYMENT_ID),
    pattern_rule("invoice_id", INVOICE_ID),
    pattern_rule("customer_id", CUSTOMER_ID),
    date_rule("payment_date"),
    Rule("amount_paid", f"coalesce({amount('amount_paid')}, 0) <= 0", "amount_paid"),
    code_rule("payment_method", PAYMENT_METHODS),
    code_rule("status", PAYMENT_STATUSES),
]

RETURN_RULES = [
    pattern_rule("return_id", RETURN_ID),
    pattern_rule("original_invoice_id", INVOICE_ID),
    pattern_rule("customer_id", CUSTOMER_ID),
    date_rule("return_date"),
    *line_rules(["original_sku", "returned_sku"]),
    code_rule("reason_code", RETURN_REASONS),
    code_rule("status", RETURN_STATUSES),
]

RULES = {"invoices": INVOICE_RULES, "payments": PAYMENT_RULES, "returns": RETURN_RULES}
KEYS = {"invoices": "invoice_id", "payments": "payment_id", "returns": "return_id"}


def with_violations(records: DataFrame, rules: list[Rule]) -> DataFrame:
    """Records with the array of rules they break, empty for good ones."""
    broken = kept_where([(r.fails, f"struct('{r.name}', CAST({r.value} AS STRING))") for r in rules], VIOLATION)
    return once(records, records.columns, broken, "violations")


def violations(checked: DataFrame, entity: str) -> DataFrame:
    """One row per broken rule: entity, entity_id, rule, value."""
    return checked.selectExpr(
        f"{KEYS[entity]} AS entity_id", "explode(violations) AS violation"
    ).selectExpr(f"'{entity}' AS entity", "entity_id", "violation.rule", "violation.value")


def rejected(strict_dates: bool = False) -> str:
    """Whether a record's broken rules set it aside; unreadable dates only if ``strict_dates``."""
    if strict_dates:
        return "size(violations) > 0"
    return f"exists(violations, v -> v.rule NOT IN ({_list(DATE_RULES)}))"


def load_audit(checked: DataFrame, entity: str, strict_dates: bool = False) -> DataFrame:
    """One row: records read, accepted and set aside."""
    return checked.agg(
        F.expr("count(*) AS total_rows"),
        F.expr(f"count_if(NOT {rejected(strict_dates)}) AS valid_rows"),
        F.expr(f"count_if({rejected(strict_dates)}) AS skipped_rows"),
    ).selectExpr(f"'{entity}' AS entity", "total_rows", "valid_rows", "skipped_rows")


# --- the declared document schemas ------------------------------------------------------


@dataclass(frozen=True)
class Shape:
    """What a document (or a line) must look like: a column that is NULL counts as absent."""

    required: list[str]
    patterns: dict[str, str] = field(default_factory=dict)
    codes: dict[str, list[str]] = field(default_factory=dict)
    numbers: dict[str, str] = field(default_factory=dict)
    integers: dict[str, str] = field(default_factory=dict)
    texts: list[str] = field(default_factory=list)
    lines: Shape | None = None

    def names(self) -> set[str]:
        own = {*self.patterns, *self.codes, *self.numbers, *self.integers, *self.texts}
        return own | ({"line_items"} if self.lines else set())


# The declared schemas; names, bounds and required fields must match.
SHAPES = {
    "invoices": Shape(
        required=["invoice_id", "customer_id", "order_date", "line_items", "total_amount",
                  "currency", "status"],
        patterns={"invoice_id": INVOICE_ID, "customer_id": CUSTOMER_ID},
        codes={"currency": CURRENCIES, "status": INVOICE_STATUSES},
        numbers={"total_amount": "0", "amount_paid": "0"},
        texts=["order_date", "due_date", "notes"],
        lines=Shape(
            required=["sku", "quantity", "unit_price"],
            patterns={"sku": SKU},
            integers={"quantity": "1"},
            numbers={"unit_price": "0", "line_total": "0"},
            texts=["description"],
        ),
    ),
    "payments": Shape(
        required=["payment_id", "invoice_id", "customer_id", "payment_date", "amount_paid",
                  "payment_method", "status"],
        patterns={"payment_id": PAYMENT_ID, "invoice_id": INVOICE_ID, "customer_id": CUSTOMER_ID},
        codes={"payment_method": PAYMENT_METHODS, "status": PAYMENT_STATUSES},
        numbers={"amount_paid": "0.01"},
        texts=["payment_date", "reference_number", "notes"],
    ),
    "returns": Shape(
        required=["return_id", "original_invoice_id", "return_date", "line_items", "reason_code",
                  "status"],
        patterns={"return_id": RETURN_ID, "original_invoice_id": INVOICE_ID,
                  "customer_id": CUSTOMER_ID},
        codes={"reason_code": RETURN_REASONS, "status": RETURN_STATUSES},
        texts=["return_date", "credit_memo_id", "notes"],
        lines=Shape(
            required=["original_sku", "returned_sku", "quantity", "unit_price"],
            patterns={"original_sku": SKU, "returned_sku": SKU},
            integers={"quantity": "1"},
            numbers={"unit_price": "0"},
            texts=["notes"],
        ),
    ),
}

ERROR = "struct<place:string,step:int,path:string,rule:string>"


def _errors(shape: Shape, present: list[str], value_prefix: str, place: str, path: str) -> list[tuple[str, str]]:
    """Test and value of every possible error at this level; ``place`` orders errors by path."""
    step = iter(range(1000))

    def error(test: str, name: str, rule: str) -> tuple[str, str]:
        own_place = f"concat({place}, '{name}')" if name else f"trim(TRAILING '/' FROM {place})"
        own_path = f"concat({path}, '{name}')" if name else f"trim(TRAILING '/' FROM {path})"
        return test, f"struct({own_place}, {next(step)}, {own_path}, '{rule}')"

    def col(name: str) -> str:
        return f"{value_prefix}{name}"

    found = [
        error(f"{col(n)} IS NULL" if n in present else "true", "", "required")
        for n in shape.required
    ]
    for name, pattern in shape.patterns.items():
        if name in present:
            found.append(error(f"{col(name)} IS NOT NULL AND NOT {matches(col(name), pattern)}", name, "pattern"))
    for name, codes in shape.codes.items():
        if name in present:
            found.append(error(f"{col(name)} NOT IN ({_list(codes)})", name, "enum"))
    for name, least in {**shape.numbers, **shape.integers}.items():
        if name not in present:
            continue
        number = f"try_cast({col(name)} AS DECIMAL(28,6))"
        whole_only = f" OR {number} <> floor({number})" if name in shape.integers else ""
        found.append(error(f"{col(name)} IS NOT NULL AND ({number} IS NULL{whole_only})", name, "type"))
        found.append(error(f"{number} < {least}", name, "minimum"))
    for name in present:
        if name not in shape.names():
            found.append(error(f"{col(name)} IS NOT NULL", "", "additionalProperties"))
    return found


def schema_violations(records: DataFrame, entity: str) -> DataFrame:
    """Per bad document: the first error in path order and the number of errors.

    ``records`` holds text columns and ``line_items`` as an array of text lines.
    """
    shape = SHAPES[entity]
    present = list(records.columns)
    own = _errors(shape, present, "", "''", "''")
    errors = kept_where(own, ERROR)
    if shape.lines:
        own.append(("size(line_items) < 1", "struct('line_items', 0, 'line_items', 'minItems')"))
        line = records.schema["line_items"].dataType.elementType.fieldNames()
        per_line = _errors(
            shape.lines, line, "l.",
            "concat('line_items/', lpad(CAST(i AS STRING), 9, '0'), '/')",
            "concat('line_items/', CAST(i AS STRING), '/')",
        )
        # a good line costs one test; which rules are broken is asked of bad ones only
        any_broken = " OR ".join(f"({test})" for test, _ in per_line)
        errors = (
            f"concat({kept_where(own, ERROR)}, coalesce(flatten(transform(line_items, (l, i) -> CASE WHEN {any_broken} "
            f"THEN {kept_where(per_line, ERROR)} ELSE CAST(array() AS array<{ERROR}>) END)), array()))"
        )
    named = records.withColumn("entity_id", F.col(KEYS[entity]))
    return (
        once(named, ["entity_id"], f"sort_array({errors})", "errors")
        .where("size(errors) > 0")
        .selectExpr(
            f"'{entity}' AS entity", "entity_id",
            "errors[0].path AS first_path", "errors[0].rule AS first_rule",
            "size(errors) AS total_errors",
        )
    )


# --- single checks ----------------------------------------------------------------------


def date_range_check(records: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Records whose start lies after their end."""
    return records.where(f"{start} > {end}").selectExpr(
        f"{key} AS entity_id", f"{start} AS start_date", f"{end} AS end_date"
    )


def positive_amount_check(records: DataFrame, key: str, column: str) -> DataFrame:
    """Records whose amount is zero or less."""
    return records.where(f"{column} <= 0").selectExpr(f"{key} AS entity_id", f"{column} AS amount")


def currency_check(records: DataFrame, key: str, column: str = "currency") -> DataFrame:
    """Whether a currency code, in any case, is a known one."""
    return records.selectExpr(
        f"{key} AS entity_id", column,
        f"coalesce(upper({column}) IN ({_list(KNOWN_CURRENCIES)}), false) AS is_known",
    )


# --- warehouse and flat constraints -----------------------------------------------------

# The declared constraints of the warehouse tables, then those of the flat ones.
CHECKS = {
    "ar_invoices": {
        "chk_invoice_status": f"status IN ({_list(INVOICE_STATUSES)})",
        "chk_invoice_currency": f"currency IN ({_list(CURRENCIES)})",
        "chk_invoice_total_positive": "total_amount >= 0",
        "chk_invoice_amount_paid": "amount_paid >= 0",
    },
    "ar_invoice_line_items": {
        "chk_line_item_qty": "quantity >= 1", "chk_line_item_price": "unit_price >= 0",
    },
    "ar_payments": {
        "chk_payment_method": f"payment_method IN ({_list(PAYMENT_METHODS)})",
        "chk_payment_status": f"status IN ({_list(PAYMENT_STATUSES)})",
        "chk_payment_amount_positive": "amount_paid > 0",
    },
    "ar_payment_allocations": {"chk_allocated_amount_positive": "allocated_amount > 0"},
    "ar_returns": {
        "chk_return_reason_code": f"reason_code IN ({_list(RETURN_REASONS)})",
        "chk_return_status": f"status IN ({_list(RETURN_STATUSES)})",
    },
    "ar_return_line_items": {
        "chk_return_line_qty": "quantity >= 1", "chk_return_line_price": "unit_price >= 0",
    },
    "ar_reconciliation_results": {
        "chk_discrepancy_type": "discrepancy_type IN ('SKU_MISMATCH', 'OVERPAYMENT', 'UNDERPAYMENT',"
                                " 'ORPHAN_PAYMENT', 'ORPHAN_RETURN', 'SCHEMA_ERROR', 'OTHER')",
        "chk_classification": "classification IN ('FRAUD', 'ERROR', 'SUBSTITUTION', 'OVERPAYMENT',"
                              " 'UNDERPAYMENT', 'UNKNOWN')",
    },
}
PRIMARY_KEYS = {
    "ar_invoices": "invoice_id", "ar_payments": "payment_id", "ar_returns": "return_id",
    "ar_reconciliation_results": "result_id", "ar_pipeline_run_summary": "pipeline_run_id",
}
FOREIGN_KEYS = [
    ("fk_invoice_line_invoice", "ar_invoice_line_items", "invoice_id", "ar_invoices"),
    ("fk_payment_invoice", "ar_payments", "invoice_id", "ar_invoices"),
    ("fk_alloc_payment", "ar_payment_allocations", "payment_id", "ar_payments"),
    ("fk_alloc_invoice", "ar_payment_allocations", "invoice_id", "ar_invoices"),
    ("fk_return_invoice", "ar_returns", "original_invoice_id", "ar_invoices"),
    ("fk_return_line_return", "ar_return_line_items", "return_id", "ar_returns"),
]
# What identifies a row of a child table in the report.
ROW_KEYS = {
    "ar_invoice_line_items": "invoice_id", "ar_payment_allocations": "payment_id",
    "ar_return_line_items": "return_id", **PRIMARY_KEYS,
}


def missing_parents(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose (non-null) reference has no parent."""
    known = parent.selectExpr(f"{key} AS {column}")
    return child.where(f"{column} IS NOT NULL").join(known, column, "left_anti")


NOT_NULL = {
    "ar_invoices": ("invoice_id", "customer_id", "order_date", "total_amount", "amount_paid", "currency", "status"),
    "ar_invoice_line_items": ("invoice_id", "sku", "quantity", "unit_price", "line_total"),
    "ar_payments": (
        "payment_id", "invoice_id", "customer_id", "payment_date", "amount_paid", "payment_method", "status"),
    "ar_payment_allocations": ("payment_id", "invoice_id", "allocated_amount", "allocation_date"),
    "ar_returns": (
        "return_id", "original_invoice_id", "customer_id", "return_date", "reason_code", "status", "sku_mismatch_flag"),
    "ar_return_line_items": (
        "return_id", "original_sku", "returned_sku", "quantity", "unit_price", "line_total", "has_sku_mismatch"),
    "ar_reconciliation_results": (
        "result_id", "pipeline_run_id", "run_date", "run_timestamp", "discrepancy_type", "customer_id", "entity_id",
        "is_fraud_alert", "is_resolved", "environment", "created_at"),
    "ar_pipeline_run_summary": (
        "pipeline_run_id", "run_timestamp", "environment", "invoices_processed", "payments_processed",
        "returns_processed", "sku_mismatches_detected", "overpayments_detected", "underpayments_detected",
        "fraud_alerts", "high_risk_customers", "pipeline_success"),
}
WAREHOUSE_RULES = {
    name: Rules(
        key=(PRIMARY_KEYS[name],) if name in PRIMARY_KEYS else (),
        not_null=NOT_NULL[name],
        checks=CHECKS.get(name, {}),
        references=tuple((rule, (column,), parent) for rule, child, column, parent in FOREIGN_KEYS if child == name),
        row_key=(ROW_KEYS[name],),
    )
    for name in NOT_NULL
}
FLAT_RULES = {
    "customers": Rules(key=("customer_id",)),
    "invoices": Rules(key=("invoice_id",), references=(("fk_invoices_customer", ("customer_id",), "customers"),)),
    "payments": Rules(key=("payment_id",)),
    "returns": Rules(key=("return_id",)),
    "credits": Rules(key=("credit_id",)),
    "payment_invoice_links": Rules(
        key=("payment_id", "invoice_id"), references=(("fk_links_payment", ("payment_id",), "payments"),)),
    "recon_config_active": Rules(
        key=("id",), not_null=("days_window", "tolerance_amount"), checks={"chk_config_single_row": "id = 1"}),
}


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Broken NOT NULL, CHECK, PRIMARY KEY and FOREIGN KEY constraints of the given warehouse tables."""
    return violations_of(tables, WAREHOUSE_RULES)


def flat_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """The same for the flat tables, the payment links (a composite key) and the stored settings."""
    return violations_of(tables, FLAT_RULES)


def flat_fk_violations(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Flat invoices of unknown customers."""
    return missing_parents(invoices, "customer_id", customers, "customer_id").select(
        "invoice_id", "customer_id"
    )
