"""Every operator and query by name, over the supplied test tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitmatch.functions.parsing import amount, date, parse_lines, quantity, whole
from remitmatch.harness import testdata as data
from remitmatch.harness.testdata import AS_OF, RAW, flat_tables
from remitmatch.operators import (
    aging, customers, discrepancies, instalments, invoices, links, mismatches, netting, pairs,
    payments, validation,
)
from remitmatch.operators.matching import match_payments
from remitmatch.plans import pipeline, recon, stages
from remitmatch.schemas import FLAT, RUN_SUMMARY
from remitmatch.session import scratch_path, written
from remitmatch.settings import DEFAULT, PRESETS, Setting, active_relation, active_settings, config_table
from remitmatch.sinks import outputs
from remitmatch.sources import catalog, documents, drops, flat_csv
from remitmatch.streaming import daily_drop, intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Plain comparable types: money as DOUBLE, whole numbers as BIGINT."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            columns.append(f"CAST(`{field.name}` AS DOUBLE) AS `{field.name}`")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            columns.append(f"CAST(`{field.name}` AS BIGINT) AS `{field.name}`")
        else:
            columns.append(f"`{field.name}`")
    return df.selectExpr(*columns)


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- flat track: the matcher --------------------------------------------------------------


@query
def recon_results(spark, sf_dir):
    return recon.recon_results(flat_tables(spark, sf_dir), [DEFAULT])


@query
def recon_results_crowded(spark, sf_dir):
    """The same results with every date treated as crowded, all answers by sorted look-up."""
    return recon.recon_results(flat_tables(spark, sf_dir), [DEFAULT], inline_limit=0)


@query
def recon_results_stored(spark, sf_dir):
    """Results under a stored row of 90 days and 75.00, read by the plan itself."""
    path = scratch_path(spark, "recon_config_active")
    config_table(spark, [Setting("active", 90, Decimal("75.00")), Setting("other", 5, Decimal("1.00"))]).selectExpr(
        "CASE scenario WHEN 'active' THEN 1 ELSE 2 END AS id", "days_window", "tolerance_amount").write.parquet(path)
    return recon.recon_results(flat_tables(spark, sf_dir), active_relation(spark.read.parquet(path)))


@query
def recon_scenarios(spark, sf_dir):
    return recon.recon_scenarios(flat_tables(spark, sf_dir), PRESETS)


@query
def recon_needs_review(spark, sf_dir):
    return recon.needs_review(recon_results(spark, sf_dir))


@query
def recon_dashboard(spark, sf_dir):
    return recon.dashboard(recon_results(spark, sf_dir))


@query
def recon_sanity(spark, sf_dir):
    tables = flat_tables(spark, sf_dir)
    return recon.recon_sanity(tables["payments"], recon_results(spark, sf_dir))


@query
def recon_config(spark, sf_dir):
    """The default setting stored, read back as the active one, over the payments it governs."""
    path = scratch_path(spark, "recon_config_active")
    config_table(spark, [DEFAULT]).selectExpr("1 AS id", "*").write.parquet(path)
    (setting,) = active_settings(spark.read.parquet(path))
    return flat_tables(spark, sf_dir)["payments"].selectExpr(
        "payment_id", f"{setting.days_window} AS days_window",
        f"CAST({setting.tolerance} AS DECIMAL(18,2)) AS tolerance_amount",
        f"date_sub(payment_date, {setting.days_window}) AS window_start",
        "payment_date AS window_end",
    )


@query
def credits_by_invoice(spark, sf_dir):
    return netting.credits_by_invoice(flat_tables(spark, sf_dir)["credits"])


@query
def returns_by_invoice(spark, sf_dir):
    return netting.returns_by_invoice(flat_tables(spark, sf_dir)["returns"])


def _net(spark, sf_dir):
    tables = flat_tables(spark, sf_dir)
    return netting.invoice_net_due(tables["invoices"], tables["credits"], tables["returns"])


def _matched(spark, sf_dir):
    tables = flat_tables(spark, sf_dir)
    return match_payments(
        tables["payments"], tables["invoices"], tables["credits"], tables["returns"], [DEFAULT],
    )


@query
def invoice_net_due(spark, sf_dir):
    return _net(spark, sf_dir)


@query
def eligible_invoices(spark, sf_dir):
    tables = flat_tables(spark, sf_dir)
    return pairs.eligible_invoices(tables["payments"], _net(spark, sf_dir), DEFAULT, doubles=True)


@query
def eligible_counts(spark, sf_dir):
    return pairs.eligible_counts(_matched(spark, sf_dir))


@query
def single_best(spark, sf_dir):
    return pairs.single_best(flat_tables(spark, sf_dir)["payments"], _net(spark, sf_dir), DEFAULT)


@query
def single_match(spark, sf_dir):
    return pairs.single_match(_matched(spark, sf_dir))


@query
def greedy_ranked(spark, sf_dir):
    return greedy_running(spark, sf_dir).select("payment_id", "invoice_id", "invoice_date", "seq")


@query
def greedy_running(spark, sf_dir):
    return pairs.greedy_running(
        flat_tables(spark, sf_dir)["payments"], _net(spark, sf_dir), DEFAULT, doubles=True
    )


@query
def greedy_cutoff(spark, sf_dir):
    return pairs.greedy_cutoff(_matched(spark, sf_dir))


@query
def payment_invoice_links(spark, sf_dir):
    return links.payment_invoice_links(flat_tables(spark, sf_dir)["payments"])


@query
def flat_fk_violations(spark, sf_dir):
    tables = flat_tables(spark, sf_dir)
    return validation.flat_fk_violations(tables["invoices"], tables["customers"])


# --- flat track: files ---------------------------------------------------------------------


def _export_flat(spark, sf_dir, suffix):
    root = scratch_path(spark, "flat")
    for name, df in flat_tables(spark, sf_dir, owners=True).items():
        outputs.export_csv(df, f"{root}/{name}{suffix}")
    return root


@query
def flat_load_counts(spark, sf_dir):
    """All five tables written as CSV and loaded back typed: rows, and a sum to check values."""
    loaded = flat_csv.load_flat_tables(spark, _export_flat(spark, sf_dir, ".csv"))
    checks = {
        "customers": "sum(customer_id)", "invoices": "sum(invoice_amount)",
        "payments": "sum(payment_amount)", "returns": "sum(credit_amount)",
        "credits": "sum(coalesce(applied_invoice_id, 0))",
    }
    return union(
        [
            loaded[name].agg(
                F.expr("count(*) AS row_count"),
                F.expr(f"CAST({checks[name]} AS DECIMAL(28,2)) AS check_sum"),
            ).selectExpr(f"'{name}' AS table_name", "row_count", "check_sum")
            for name in FLAT
        ]
    )


@query
def ext_table_counts(spark, sf_dir):
    """The same tables as text views over CSV prefixes."""
    flat_csv.external_tables(spark, _export_flat(spark, sf_dir, ""))
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, "
            f"count(DISTINCT {next(iter(FLAT[name]))}) AS key_count FROM {name}"
            for name in FLAT
        )
    )


@query
def export_roundtrip(spark, sf_dir):
    """The three result views exported to CSV and read back."""
    results = written(recon_results(spark, sf_dir), "results")
    views = {
        "results": results, "needs_review": recon.needs_review(results),
        "dashboard": recon.dashboard(results),
    }
    outputs.register_views(views)
    paths = outputs.export_views(spark, scratch_path(spark, "exports"))
    totals = {"recon_dashboard_summary_active": "total_payment_amount"}
    return union(
        [
            documents.read_csv_text(spark, path).selectExpr(
                f"'{name}' AS view_name", "match_type",
                f"CAST({totals.get(name, 'payment_amount')} AS DECIMAL(28,2)) AS paid",
            ).groupBy("view_name", "match_type").agg(
                F.expr("count(*) AS row_count"), F.expr("sum(paid) AS paid")
            )
            for name, path in paths.items()
        ]
    )


def _snapshots(spark, sf_dir):
    """Weekly dashboards, each over the payments known by then; the last date is run twice."""
    root = scratch_path(spark, "snapshots")
    results = written(recon_results(spark, sf_dir), "results")
    path = None
    for run_date in ("1998-01-05", "1998-01-12", "1998-01-19", "1998-01-19"):
        known = results.where(f"payment_date <= DATE'{run_date}'")
        path = outputs.write_snapshot(
            recon.dashboard(known), root, "recon_dashboard_summary_history", run_date
        )
    return spark.read.parquet(path)


@query
def snapshot_roundtrip(spark, sf_dir):
    """Needs-review detail of two dates, written as dated snapshots and read back."""
    root = scratch_path(spark, "snapshots")
    review = written(recon_needs_review(spark, sf_dir).select(
        "payment_id", "payment_date", "payment_amount", "match_type"
    ), "review")
    for run_date in ("1999-06-07", "1999-06-14", "1999-06-14"):
        path = outputs.write_snapshot(
            review.where(f"payment_date <= DATE'{run_date}'"), root,
            "recon_needs_review_history", run_date,
        )
    return spark.read.parquet(path)


@query
def snapshot_trend(spark, sf_dir):
    """Dashboard counts by run date."""
    return _snapshots(spark, sf_dir).select(
        "run_date", "match_type", "payment_count", "total_payment_amount"
    )


# --- documents -------------------------------------------------------------------------------


@query
def parse_line_items(spark, sf_dir):
    """Lines of raw invoices, from JSON or literal text, quantities and prices coerced."""
    parsed = parse_lines(data.raw_invoices(spark, sf_dir), documents.INVOICE_LINES_RAW)
    return parsed.selectExpr("invoice_id", "explode(line_items) AS line").selectExpr(
        "invoice_id", "line.sku", "line.description",
        f"{quantity('line.quantity')} AS quantity", f"{amount('line.unit_price', 4)} AS unit_price",
    )


@query
def line_quantities(spark, sf_dir):
    """Quantities by type: whole and broken numbers, numbers as text, and broken numbers as text, which are none."""
    raw = data.raw_invoices(spark, sf_dir).withColumn("line_items", F.expr(
        """CASE WHEN CAST(substring(order_date, 9) AS INT) % 2 = 0
                THEN regexp_replace(line_items, '(?<=quantity.: )([0-9]+[.]7)', '"$1"') ELSE line_items END"""))
    return parse_lines(raw, documents.INVOICE_LINES_RAW).selectExpr(
        "invoice_id", "order_date", "explode(line_items) AS line").selectExpr(
        "invoice_id", "order_date", "line.sku", f"{quantity('line.quantity')} AS quantity")


@query
def coerce_amounts(spark, sf_dir):
    return data.raw_payments(spark, sf_dir).selectExpr(
        "payment_id", "amount_paid AS amount_text", f"{amount('amount_paid')} AS amount_paid",
        f"{whole('amount_paid')} AS whole_amount", f"{date('payment_date')} AS payment_date",
    )


@query
def defaults(spark, sf_dir):
    """Missing cells and a missing currency column."""
    raw = data.raw_invoices(spark, sf_dir).drop("currency")
    raw = raw.withColumn("amount_paid", F.expr("CASE WHEN status <> 'OPEN' THEN amount_paid ELSE 'NA' END"))
    arranged = documents.arrange(raw, "invoices")
    return arranged.selectExpr(
        "invoice_id", f"coalesce({amount('amount_paid')}, 0.00) AS amount_paid", "currency",
        "due_date", "notes",
    )


def _scanned(spark, sf_dir, entity):
    path = scratch_path(spark, f"{entity}.csv")
    outputs.export_csv(RAW[entity](spark, sf_dir), path)
    return documents.scan(spark, entity, path)


@query
def scan_invoices(spark, sf_dir):
    valid = _scanned(spark, sf_dir, "invoices").valid
    return invoices.computed_totals(valid).join(
        valid.select("invoice_id", "customer_id", "order_date", "due_date", "amount_paid",
                     "currency", "status", "notes"),
        "invoice_id",
    )


@query
def scan_payments(spark, sf_dir):
    return _scanned(spark, sf_dir, "payments").valid


@query
def scan_returns(spark, sf_dir):
    valid = _scanned(spark, sf_dir, "returns").valid
    return invoices.return_values(valid).join(valid.drop("line_items"), "return_id")


def _checked(spark, sf_dir, entity):
    return documents.read_documents(RAW[entity](spark, sf_dir), entity)


@query
def invoice_violations(spark, sf_dir):
    return validation.violations(_checked(spark, sf_dir, "invoices"), "invoices")


@query
def payment_violations(spark, sf_dir):
    return validation.violations(_checked(spark, sf_dir, "payments"), "payments")


@query
def return_violations(spark, sf_dir):
    return validation.violations(_checked(spark, sf_dir, "returns"), "returns")


@query
def schema_violations(spark, sf_dir):
    parts = []
    for entity in RAW:
        records = documents.arrange(RAW[entity](spark, sf_dir), entity)
        if entity in documents.LINE_LAYOUTS:
            records = parse_lines(records, documents.LINE_LAYOUTS[entity], coerce=False)
        parts.append(validation.schema_violations(records, entity))
    return union(parts)


@query
def load_audit(spark, sf_dir):
    return union([validation.load_audit(_checked(spark, sf_dir, e), e) for e in RAW])


@query
def quarantine(spark, sf_dir):
    """Bad payment records as they came, with the rules they break."""
    return documents.split(_checked(spark, sf_dir, "payments"), "payments").quarantine.selectExpr(
        "payment_id", "invoice_id", "amount_paid", "array_join(transform(violations, v -> v.rule), ',') AS rules",
    )


@query
def orphan_payments(spark, sf_dir):
    return payments.orphan_payments(data.ar_payments(spark, sf_dir), data.ar_invoices(spark, sf_dir))


@query
def orphan_returns(spark, sf_dir):
    return payments.orphan_returns(data.return_headers(spark, sf_dir), data.ar_invoices(spark, sf_dir))


@query
def date_range_check(spark, sf_dir):
    """Payments made after their invoice was due."""
    matched = _matches(spark, sf_dir)
    return validation.date_range_check(matched, "payment_id", "payment_date", "invoice_due_date")


@query
def positive_amount_check(spark, sf_dir):
    raw = data.raw_payments(spark, sf_dir).selectExpr("payment_id", f"{amount('amount_paid')} AS amount_paid")
    return validation.positive_amount_check(raw, "payment_id", "amount_paid")


@query
def currency_check(spark, sf_dir):
    raw = data.raw_invoices(spark, sf_dir).selectExpr(
        "invoice_id", "CASE WHEN status = 'OPEN' THEN lower(currency) ELSE currency END AS currency"
    )
    return validation.currency_check(raw, "invoice_id")


def _warehouse(spark, sf_dir):
    return {
        "ar_invoices": data.ar_invoices(spark, sf_dir),
        "ar_invoice_line_items": data.ar_invoice_line_items(spark, sf_dir),
        "ar_payments": data.ar_payments(spark, sf_dir),
        "ar_payment_allocations": data.ar_payment_allocations(spark, sf_dir),
        "ar_returns": data.ar_returns(spark, sf_dir),
        "ar_return_line_items": data.ar_return_line_items(spark, sf_dir),
    }


@query
def constraint_violations(spark, sf_dir):
    """The warehouse tables, the payments among them with the raw records' broken values."""
    tables = _warehouse(spark, sf_dir)
    tables["ar_payments"] = data.raw_payments(spark, sf_dir).withColumn(
        "amount_paid", F.expr(amount("amount_paid"))
    )
    return validation.constraint_violations(tables)


@query
def flat_key_violations(spark, sf_dir):
    """Keys, NOT NULL and references of the flat tables, the links and the settings, with rows that break them."""
    tables = flat_tables(spark, sf_dir, owners=True)
    customers, paid = tables["customers"], tables["payments"]
    nobody = customers.where("customer_id % 50 = 0").withColumn("customer_id", F.lit(None).cast("bigint"))
    linked = links.payment_invoice_links(paid)
    tables |= {
        "customers": customers.unionByName(nobody),
        "payments": paid.unionByName(paid.where("payment_id % 97 = 0")),
        "payment_invoice_links": linked.unionByName(linked.where("payment_id % 83 = 0 AND invoice_id % 2 = 0"))
        .unionByName(linked.where("payment_id % 79 = 0").withColumn("payment_id", F.expr("-payment_id")))
        .unionByName(linked.where("payment_id % 91 = 0").withColumn("invoice_id", F.lit(None).cast("bigint"))),
        "recon_config_active": config_table(spark, PRESETS[:2]).selectExpr(
            "CASE scenario WHEN '03a' THEN 1 ELSE 2 END AS id", "nullif(tolerance_amount, 100) AS tolerance_amount",
            "days_window"),
    }
    return validation.flat_key_violations(tables)


@query
def results_violations(spark, sf_dir):
    """Constraints of the results and summary tables, over the results of two runs with rows that break them."""
    report = written(_report(spark, sf_dir), "report")
    rows = outputs.results_rows(report, "run-1", AS_OF)
    number = "CAST(substring(entity_id, 5) AS BIGINT)"
    bad = rows.withColumns({
        "result_id": F.expr(f"{number} * 10 + CASE discrepancy_type WHEN 'SKU_MISMATCH' THEN 1 ELSE 2 END"),
        "classification": F.expr(f"CASE WHEN {number} % 7 = 0 THEN 'WRONG' ELSE classification END"),
        "discrepancy_type": F.expr(f"CASE WHEN {number} % 11 = 0 THEN 'BOGUS' ELSE discrepancy_type END"),
        "customer_id": F.expr(f"CASE WHEN {number} % 13 <> 0 THEN customer_id END"),
    })
    numbers = [c for c, kind in RUN_SUMMARY.items() if kind == "bigint"]
    counts = bad.groupBy("discrepancy_type").agg(*[F.count("*").alias(c) for c in numbers])
    summary = outputs.summary_row(counts, "run-1").withColumn("high_risk_customers", F.lit(None).cast("bigint"))
    return validation.constraint_violations(
        {"ar_reconciliation_results": bad, "ar_pipeline_run_summary": summary}
    ).groupBy("table_name", "constraint_name").agg(
        F.count("*").alias("broken"), F.count_distinct("row_key").alias("rows"))


@query
def explode_return_lines(spark, sf_dir):
    return mismatches.return_lines(data.return_documents(spark, sf_dir))


@query
def line_totals(spark, sf_dir):
    return invoices.line_totals(data.ar_invoice_line_items(spark, sf_dir), "invoice_id")


@query
def invoice_balances(spark, sf_dir):
    return invoices.invoice_balances(data.ar_invoices(spark, sf_dir))


@query
def invoice_computed_total(spark, sf_dir):
    return invoices.computed_totals(data.invoice_documents(spark, sf_dir))


@query
def payment_allocations(spark, sf_dir):
    return payments.payment_allocations(
        data.ar_payments(spark, sf_dir), data.ar_payment_allocations(spark, sf_dir)
    )


@query
def payment_flags(spark, sf_dir):
    return payments.payment_flags(data.ar_payments(spark, sf_dir))


@query
def return_mismatch_flag(spark, sf_dir):
    return mismatches.flag_returns(data.return_documents(spark, sf_dir))


@query
def return_value(spark, sf_dir):
    return invoices.return_values(data.return_documents(spark, sf_dir))


def _matches(spark, sf_dir):
    return payments.match_by_reference(
        data.ar_payments(spark, sf_dir), payments.latest_by_id(data.ar_invoice_versions(spark, sf_dir))
    )


@query
def payment_match(spark, sf_dir):
    return _matches(spark, sf_dir)


@query
def overpayments(spark, sf_dir):
    return payments.overpayments(_matches(spark, sf_dir))


@query
def underpayments(spark, sf_dir):
    return payments.underpayments(_matches(spark, sf_dir))


def _mismatches(spark, sf_dir):
    return mismatches.mismatch_report(data.return_documents(spark, sf_dir))


@query
def mismatch_report(spark, sf_dir):
    return _mismatches(spark, sf_dir)


@query
def sku_classify(spark, sf_dir):
    return _mismatches(spark, sf_dir).select(
        "return_id", "original_sku", "returned_sku", "line_value", "reason_code", "classification"
    )


@query
def mismatch_class_counts(spark, sf_dir):
    return mismatches.class_counts(_mismatches(spark, sf_dir))


@query
def fraud_alerts(spark, sf_dir):
    return mismatches.fraud_alerts(_mismatches(spark, sf_dir))


def _report(spark, sf_dir):
    return discrepancies.discrepancy_report(_mismatches(spark, sf_dir), _matches(spark, sf_dir))


@query
def discrepancy_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query
def discrepancy_totals(spark, sf_dir):
    return discrepancies.discrepancy_totals(_report(spark, sf_dir))


@query
def high_risk_accounts(spark, sf_dir):
    return discrepancies.high_risk_accounts(_report(spark, sf_dir))


@query
def aging_report(spark, sf_dir):
    return aging.aging_report(data.ar_invoices(spark, sf_dir), data.ar_payments(spark, sf_dir), AS_OF)


@query
def aging_bucket_counts(spark, sf_dir):
    return aging.aging_bucket_counts(aging_report(spark, sf_dir))


@query
def report_export(spark, sf_dir):
    """The discrepancy list as a dated CSV report, read back."""
    path = outputs.write_report(_report(spark, sf_dir), scratch_path(spark, "processed"), AS_OF)
    return documents.read_csv_text(spark, path).selectExpr(
        "discrepancy_type", "entity_id", "customer_id", "reference_id",
        "CAST(amount AS DECIMAL(28,4)) AS amount", "detail", "classification",
    )


@query
def results_table(spark, sf_dir):
    """The discrepancy list of two runs of one date, one of them written twice, read back."""
    root = scratch_path(spark, "warehouse")
    report = written(_report(spark, sf_dir), "report")
    for run_id in ("run-1", "run-2", "run-1"):
        outputs.write_results(outputs.results_rows(report, run_id, AS_OF), root, AS_OF, run_id)
    return outputs.read_results(spark, root).selectExpr(
        "run_date", "pipeline_run_id", "discrepancy_type", "customer_id", "entity_id",
        "reference_id", "discrepancy_amount", "detail", "classification", "is_fraud_alert",
        "is_resolved", "environment",
    )


def _resolved(spark, sf_dir):
    """Two runs a week apart, with a quarter of the first one's findings resolved in between."""
    root = scratch_path(spark, "warehouse")
    report = written(_report(spark, sf_dir), "report")
    later = AS_OF + datetime.timedelta(days=7)
    outputs.merge_run(spark, outputs.results_rows(report, "run-1", AS_OF), root, AS_OF, "run-1")
    settled = outputs.read_results(spark, root).where(
        "CAST(substring(entity_id, 5) AS BIGINT) % 4 = 0").selectExpr(
        "result_id", "TIMESTAMP'2024-02-01 10:00:00' AS resolved_at", "'auditor' AS resolved_by",
        "concat('settled ', entity_id) AS resolution_notes")
    outputs.resolve_results(spark, root, settled)
    outputs.merge_run(spark, outputs.results_rows(report, "run-2", later), root, later, "run-2")
    return outputs.read_results(spark, root)


@query
def results_resolved(spark, sf_dir):
    """The results table after two runs with resolutions between them."""
    return _resolved(spark, sf_dir).selectExpr(
        "run_date", "pipeline_run_id", "discrepancy_type", "customer_id", "entity_id",
        "reference_id", "discrepancy_amount", "detail", "is_fraud_alert", "is_resolved",
        "date_format(resolved_at, 'yyyy-MM-dd HH:mm') AS resolved_at", "resolved_by", "resolution_notes",
    )


@query
def unresolved_discrepancies(spark, sf_dir):
    """Unresolved findings of the later run by customer, from the stored results."""
    return customers.customer_discrepancies(_resolved(spark, sf_dir).where("pipeline_run_id = 'run-2'"))


@query
def run_summary(spark, sf_dir):
    """The document pipeline from raw CSV to its archived summary row."""
    root = scratch_path(spark, "pipeline")
    sources = {}
    for entity, raw in RAW.items():
        sources[entity] = f"{root}/{entity}.csv"
        outputs.export_csv(raw(spark, sf_dir), sources[entity], "gzip")
    pipeline.run_pipeline(spark, sources, AS_OF, "run-1", archive=root, as_of=AS_OF)
    return spark.read.parquet(f"{root}/ar_pipeline_run_summary").selectExpr(
        "pipeline_run_id", "environment", "invoices_processed", "payments_processed",
        "returns_processed", "sku_mismatches_detected", "overpayments_detected",
        "underpayments_detected", "fraud_alerts", "high_risk_customers", "pipeline_success",
    )


@query
def stage_results(spark, sf_dir):
    """The staged run from raw CSV: its ledger after a transformation that failed once and a resumed run."""
    root = scratch_path(spark, "stages")
    sources = {}
    for entity, raw in RAW.items():
        sources[entity] = f"{root}/{entity}.csv"
        outputs.export_csv(raw(spark, sf_dir), sources[entity], "gzip")

    def broken(_):
        raise RuntimeError("lost")

    stages.run_stages(spark, sources, AS_OF, "run-1", root, AS_OF, work={"transformation": broken})
    return stages.run_stages(spark, sources, AS_OF, "run-1", root, AS_OF).selectExpr(
        "position", "stage", "status", "rows", "array_join(errors, '; ') AS errors")


# Which payments arrive on which date.
DROPS = {
    "2024-01-01": "payment_method IN ('ACH', 'WIRE')",
    "2024-01-02": "payment_method = 'CHECK'",
    "2024-01-03": "payment_method NOT IN ('ACH', 'WIRE', 'CHECK')",
}


def _drop(raw, root, run_date, prefix=None):
    outputs.export_csv(raw.where(DROPS[run_date]), drops.drop_path(root, "payments", run_date, prefix))


@query
def daily_drop_ingest(spark, sf_dir):
    """Payments dropped by date: two drops, one of them wrong; a third, the wrong one rewritten, the other sent again; none."""
    root = scratch_path(spark, "raw")
    target, log = f"{root}/landed", f"{root}/log"
    raw = data.raw_payments(spark, sf_dir)
    wrong = raw.withColumn("amount_paid", F.lit("0.01")).unionByName(raw.where("payment_method = 'ACH'"))
    for batch in (
        {"2024-01-01": wrong, "2024-01-02": raw},
        {"2024-01-03": raw, "2024-01-01": raw, "2024-01-02": raw},
        {},
    ):
        for run_date, rows in batch.items():
            _drop(rows, root, run_date)
        intake.take_in(spark, root, "payments", target, log)
    return spark.read.parquet(target).selectExpr(
        "run_date", "payment_id", "invoice_id", f"{amount('amount_paid')} AS amount_paid", "payment_method"
    )


@query
def daily_drop_stream(spark, sf_dir):
    """Payments dropped by date, taken in as a file stream: two drops, then a third, then none."""
    root = scratch_path(spark, "raw")
    target, checkpoint = f"{root}/landed", f"{root}/checkpoint"
    raw = data.raw_payments(spark, sf_dir)
    for batch in (["2024-01-01", "2024-01-02"], ["2024-01-03"], []):
        for run_date in batch:
            _drop(raw, root, run_date)
        daily_drop.ingest(
            daily_drop.drop_stream(spark, root, "payments"), target, checkpoint
        ).awaitTermination()
    return spark.read.parquet(target).selectExpr(
        "run_date", "payment_id", "invoice_id", f"{amount('amount_paid')} AS amount_paid", "payment_method"
    )


@query
def daily_drop_batch(spark, sf_dir):
    """The same drops read as a batch, from another prefix."""
    root = scratch_path(spark, "raw")
    raw = data.raw_payments(spark, sf_dir)
    for run_date in DROPS:
        _drop(raw, root, run_date, "incoming/")
    return drops.read_drops(spark, root, "payments", list(DROPS), "incoming/").groupBy(
        "run_date", "payment_method"
    ).agg(F.expr("count(*) AS payments"), F.expr(f"sum({amount('amount_paid')}) AS amount_paid"))


@query
def catalog_partitions(spark, sf_dir):
    """Payments in the catalogue by date: after two drops, after a third one, and looked at again."""
    root, database = scratch_path(spark, "raw"), f"drops_{uuid.uuid4().hex}"
    raw = data.raw_payments(spark, sf_dir)
    looks = []
    try:
        for look, dates in (("first", ["2024-01-01", "2024-01-02"]), ("second", ["2024-01-03"]), ("none new", [])):
            for run_date in dates:
                _drop(raw, root, run_date)
            catalog.crawl(spark, root, database)
            looks.append(written(
                spark.table(f"{database}.payments").groupBy("run_date", "payment_method").agg(
                    F.expr("count(*) AS payments"), F.expr(f"sum({amount('amount_paid')}) AS amount_paid"))
                .selectExpr(f"'{look}' AS look", "*"), "look"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return union(looks)


# --- warehouse -------------------------------------------------------------------------------


def _results(spark, sf_dir):
    return _report(spark, sf_dir).selectExpr(
        "discrepancy_type", "customer_id", "entity_id", "reference_id",
        "amount AS discrepancy_amount", "detail", "classification",
        "classification = 'FRAUD' AS is_fraud_alert",
        "CAST(substring(entity_id, 5) AS BIGINT) % 4 = 0 AS is_resolved",
    )


@query
def sku_mismatch_detail(spark, sf_dir):
    return mismatches.sku_mismatch_detail(
        data.ar_return_line_items(spark, sf_dir), data.return_headers(spark, sf_dir),
        data.ar_invoices(spark, sf_dir),
    )


@query
def payment_sums(spark, sf_dir):
    return instalments.payment_sums(data.ar_payments(spark, sf_dir))


@query
def payment_classification(spark, sf_dir):
    return instalments.payment_classification(
        data.ar_invoices(spark, sf_dir), data.ar_payments(spark, sf_dir)
    ).groupBy("payment_classification", "invoice_status").agg(
        F.expr("count(*) AS invoices"), F.expr("sum(outstanding_balance) AS outstanding_balance")
    )


@query
def partial_payment_analysis(spark, sf_dir):
    return instalments.partial_payment_analysis(
        data.ar_invoices(spark, sf_dir), data.ar_payments(spark, sf_dir), AS_OF
    )


@query
def partial_payment_running(spark, sf_dir):
    return instalments.running_payments(
        data.ar_invoices(spark, sf_dir), data.ar_payments(spark, sf_dir)
    )


def _aged(spark, sf_dir):
    return aging.aging_warehouse(data.ar_invoices(spark, sf_dir), data.ar_payments(spark, sf_dir), AS_OF)


@query
def aging_warehouse(spark, sf_dir):
    return _aged(spark, sf_dir)


@query
def aging_bucket_summary(spark, sf_dir):
    return aging.aging_bucket_summary(_aged(spark, sf_dir))


@query
def customer_invoice_summary(spark, sf_dir):
    return customers.customer_invoice_summary(data.ar_invoices(spark, sf_dir))


@query
def customer_payment_summary(spark, sf_dir):
    return customers.customer_payment_summary(data.ar_payments(spark, sf_dir))


@query
def customer_returns_summary(spark, sf_dir):
    return customers.customer_returns_summary(data.ar_returns(spark, sf_dir))


@query
def customer_discrepancies(spark, sf_dir):
    return customers.customer_discrepancies(_results(spark, sf_dir))


@query
def customer_risk_summary(spark, sf_dir):
    return customers.customer_risk_summary(
        data.ar_invoices(spark, sf_dir), data.ar_payments(spark, sf_dir),
        data.ar_returns(spark, sf_dir), _results(spark, sf_dir),
    )


# --- reading order ---------------------------------------------------------------------------

# What is read back of each numbered report: the columns that fix a row's place.
ORDERED = {
    "aging_report": ["aging_bucket", "customer_id", "invoice_id"],
    "aging_warehouse": ["customer_id", "invoice_id"],
    "mismatch_report": ["return_id", "original_sku"],
    "sku_mismatch_detail": ["return_id", "original_sku"],
    "discrepancy_report": ["discrepancy_type", "customer_id", "entity_id", "detail"],
    "partial_payment_analysis": ["customer_id", "invoice_id"],
    "customer_risk_summary": ["customer_id"],
    "recon_dashboard": ["match_type"],
    "high_risk_accounts": ["customer_id"],
}


def _ordered(report: str, build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = outputs.write_report(build(spark, sf_dir), scratch_path(spark, "ordered"), AS_OF, report, numbered=True)
        return documents.read_csv_text(spark, path).selectExpr(
            *ORDERED[report], "CAST(position AS BIGINT) AS position")

    return run


for _name in ORDERED:
    QUERIES[f"{_name}_order"] = _ordered(_name, globals()[_name])
