"""Documents from CSV to reports, on small files with known answers."""

import datetime
from decimal import Decimal

import pytest

from remitmatch.operators import aging, discrepancies, mismatches, payments, validation
from remitmatch.plans.pipeline import detect, run_pipeline
from remitmatch.sinks.outputs import in_report_order
from remitmatch.sources.documents import read_csv_text, scan

HEADERS = {
    "invoices": "invoice_id,customer_id,order_date,due_date,line_items,total_amount,amount_paid,currency,status,notes",
    "payments": "payment_id,invoice_id,customer_id,payment_date,amount_paid,payment_method,reference_number,status,notes",
    "returns": "return_id,original_invoice_id,customer_id,return_date,line_items,reason_code,status,credit_memo_id,notes",
}
LINE = '"[{""sku"": ""SKU-WIDG01"", ""description"": ""w"", ""quantity"": 2, ""unit_price"": 50.25}]"'


def ret_line(old, new, quantity, price):
    return (
        f'"[{{""original_sku"": ""{old}"", ""returned_sku"": ""{new}"", ""quantity"": {quantity}, '
        f'""unit_price"": {price}}}]"'
    )


INVOICES = [
    f"INV-500001,CUST-7001,2024-03-01,2024-03-31,{LINE},100.50,0.00,USD,OPEN,",
    f'INV-500002,CUST-7002,2024-03-01,2024-05-10,{LINE},300.00,,EUR,PARTIAL,"said ""ok"", twice"',
    f"INV-500003,CUST-7003,2024-03-01,,{LINE},80.00,80.00,USD,PAID,NA",
    f"INV-500004,CUST-7001,2024-03-01,2024-02-01,{LINE},50.00,60.00,USD,VOID,",
    f"INV-500005,CUST-7004,2024-03-02,2024-05-20,{LINE},900.00,100.00,USD,OVERDUE,",
]
PAYMENTS = [
    "PMT-600001,INV-500001,CUST-9999,2024-03-05,100.50,ACH,R1,CLEARED,",
    "PMT-600002,INV-500002,CUST-7002,2024-03-06,350.00,WIRE,,CLEARED,",
    "PMT-600003,INV-500002,CUST-7002,2024-03-07,10.00,CASH,,FAILED,",
    "PMT-600004,INV-500003,CUST-7003,2024-03-08,79.99,EFT,,PARTIAL,",
    "PMT-600005,INV-599999,CUST-7003,2024-03-08,5.00,EFT,,PARTIAL,",
]
RETURNS = [
    f"RET-700001,INV-500001,CUST-7001,2024-04-01,{ret_line('SKU-PRMA01', 'SKU-PRMB01', 2, 100)},OTHER,APPROVED,,",
    f"RET-700002,INV-500002,CUST-7002,2024-04-02,{ret_line('SKU-PRMA01', 'SKU-PRMB01', 5, 100)},OTHER,REJECTED,,",
    f"RET-700003,INV-500003,CUST-7003,2024-04-03,{ret_line('SKU-PRMA01', 'SKU-GAMM01', 5, 200)},WRONG_ITEM,PENDING,,",
    f"RET-700004,INV-500003,CUST-7003,2024-04-03,{ret_line('SKU-PRMA01', 'SKU-PRMA01', 5, 200)},OTHER,PENDING,CM-1,",
    f"RET-700005,INV-588888,CUST-7003,2024-04-03,{ret_line('SKU-ALPH01', 'SKU-PRMA01', 1, 499.99)},OTHER,PENDING,,",
]


def write(folder, entity, rows, header=None):
    path = folder / f"{entity}.csv"
    path.write_text("\n".join([header or HEADERS[entity], *rows]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("documents")
    rows = {"invoices": INVOICES, "payments": PAYMENTS, "returns": RETURNS}
    return {name: scan(spark, name, write(folder, name, rows[name])) for name in rows}


def test_scan_types_and_defaults(loaded):
    rows = {r.invoice_id: r for r in loaded["invoices"].valid.collect()}
    assert len(rows) == 5 and loaded["invoices"].quarantine.count() == 0
    assert rows["INV-500002"].amount_paid == Decimal("0.00")
    assert rows["INV-500002"].notes == 'said "ok", twice'
    assert rows["INV-500003"].due_date is None and rows["INV-500003"].notes is None
    line = rows["INV-500001"].line_items[0]
    assert (line.sku, line.quantity, line.unit_price) == ("SKU-WIDG01", 2, Decimal("50.2500"))


def test_matches_over_and_under(loaded):
    found = detect(*(loaded[n].valid for n in ("invoices", "payments", "returns")))
    rows = {r.payment_id: r for r in found.matches.collect()}
    assert set(rows) == {"PMT-600001", "PMT-600002", "PMT-600003", "PMT-600004"}
    assert rows["PMT-600001"].customer_id == "CUST-7001"  # the invoice's, not the payment's
    assert rows["PMT-600001"].is_fully_paid and rows["PMT-600002"].balance_after_payment == 0
    over = payments.overpayments(found.matches).collect()
    assert [(r.payment_id, r.overpayment_amount) for r in over] == [("PMT-600002", Decimal("50.00"))]
    under = {r.payment_id: r.outstanding_balance for r in payments.underpayments(found.matches).collect()}
    assert under == {"PMT-600003": Decimal("290.00"), "PMT-600004": Decimal("0.01")}
    assert [r.payment_id for r in found.orphan_payments.collect()] == ["PMT-600005"]
    assert [r.return_id for r in found.orphan_returns.collect()] == ["RET-700005"]


def test_classification_priority(loaded):
    report = mismatches.mismatch_report(loaded["returns"].valid)
    kinds = {r.return_id: r.classification for r in report.collect()}
    assert kinds == {
        "RET-700001": "SUBSTITUTION",
        "RET-700002": "FRAUD",  # 500.00 is enough, and fraud comes before substitution
        "RET-700003": "ERROR",  # high value, but the reason explains it
        "RET-700005": "ERROR",
    }


def test_report_totals_and_high_risk(loaded):
    found = detect(*(loaded[n].valid for n in ("invoices", "payments", "returns")))
    totals = discrepancies.discrepancy_totals(found.report).first()
    assert (totals.sku_mismatches, totals.overpayments, totals.underpayments) == (4, 1, 2)
    assert totals.fraud_alerts == 1 and totals.has_discrepancies
    assert totals.total_overpayment_amount == 50 and totals.total_outstanding_amount == Decimal("290.01")
    risky = {r.customer_id: r.discrepancy_types for r in found.high_risk.collect()}
    assert risky == {"CUST-7002": 3, "CUST-7003": 2}
    details = {r.entity_id: r.detail for r in found.report.collect()}
    assert details["PMT-600004"] == "paid 79.99 vs invoiced 80.00"
    assert details["RET-700001"] == "SKU-PRMA01 -> SKU-PRMB01"


def test_aging(loaded):
    as_of = datetime.date(2024, 6, 1)
    found = detect(*(loaded[n].valid for n in ("invoices", "payments", "returns")), as_of)
    rows = {r.invoice_id: r for r in found.aging.collect()}
    assert "INV-500004" not in rows  # void
    assert (rows["INV-500005"].aging_bucket, rows["INV-500005"].days_past_due) == ("1-30", 12)
    assert rows["INV-500005"].outstanding_balance == 800  # no payment: the invoice's own figure
    assert rows["INV-500002"].aging_bucket == "Current" and rows["INV-500002"].amount_paid == 360
    assert rows["INV-500003"].outstanding_balance == Decimal("0.01")
    assert rows["INV-500003"].aging_bucket == "Current"  # no due date
    counts = {r.aging_bucket: r.invoices for r in found.aging_counts.collect()}
    assert counts == {"Current": 3, "1-30": 1}


def test_reading_order(loaded):
    found = detect(*(loaded[n].valid for n in ("invoices", "payments", "returns")), datetime.date(2024, 6, 1))
    listed = [(r.discrepancy_type, r.entity_id) for r in in_report_order(found.report, "discrepancy_report").collect()]
    assert listed[0] == ("OVERPAYMENT", "PMT-600002") and listed[-1] == ("UNDERPAYMENT", "PMT-600004")
    assert listed == sorted(listed, key=lambda r: r[0])
    aged = in_report_order(found.aging, "aging_report").collect()
    assert [r.aging_bucket for r in aged] == ["Current", "Current", "Current", "1-30"]
    assert "aging_sort" not in aged[0].asDict()


@pytest.mark.parametrize(
    "days, name", [(-1, "Current"), (0, "Current"), (1, "1-30"), (30, "1-30"), (31, "31-60"), (60, "31-60"),
                   (61, "61-90"), (90, "61-90"), (91, "90+")],
)
def test_bucket_edges(spark, days, name):
    invoices = spark.sql(
        f"""SELECT 'INV-1' AS invoice_id, 'C' AS customer_id, 10.00BD AS total_amount, 0.00BD AS amount_paid,
            date_sub(DATE'2024-06-01', {days}) AS due_date, 'OPEN' AS status"""
    )
    paid = spark.sql("SELECT 'x' AS invoice_id, 1.00BD AS amount_paid")
    report = aging.aging_report(invoices, paid, datetime.date(2024, 6, 1)).first()
    assert report.aging_bucket == name and report.days_past_due == max(0, days)


BAD_INVOICES = {
    "bad id": (f"INV-12,CUST-7001,2024-03-01,,{LINE},1,0,USD,OPEN,", "invoice_id"),
    "bad customer": (f"INV-500001,CUST-1,2024-03-01,,{LINE},1,0,USD,OPEN,", "customer_id"),
    "no lines": ("INV-500001,CUST-7001,2024-03-01,,[],1,0,USD,OPEN,", "line_items"),
    "unreadable lines": ("INV-500001,CUST-7001,2024-03-01,,nothing,1,0,USD,OPEN,", "line_items"),
    "currency": (f"INV-500001,CUST-7001,2024-03-01,,{LINE},1,0,XYZ,OPEN,", "currency"),
    "null currency": (f"INV-500001,CUST-7001,2024-03-01,,{LINE},1,0,,OPEN,", "currency"),
    "paid too much": (f"INV-500001,CUST-7001,2024-03-01,,{LINE},1,2,USD,OPEN,", "amount_paid_within_total"),
    "negative total": (f"INV-500001,CUST-7001,2024-03-01,,{LINE},-1,0,USD,VOID,", "total_amount"),
    "due date": (f"INV-500001,CUST-7001,2024-03-01,soon,{LINE},1,0,USD,OPEN,", "due_date"),
    "status": (f"INV-500001,CUST-7001,2024-03-01,,{LINE},1,0,USD,LOST,", "status"),
    "quantity 0": (
        'INV-500001,CUST-7001,2024-03-01,,"[{""sku"": ""SKU-AAAA"", ""quantity"": 0, ""unit_price"": 1}]",1,0,USD,OPEN,',
        "line_items.quantity",
    ),
    "line without sku": (
        'INV-500001,CUST-7001,2024-03-01,,"[{""quantity"": 1, ""unit_price"": 1}]",1,0,USD,OPEN,',
        "line_items.sku",
    ),
    "negative price": (
        'INV-500001,CUST-7001,2024-03-01,,"[{""sku"": ""SKU-AAAA"", ""quantity"": 1, ""unit_price"": -1}]",1,0,USD,OPEN,',
        "line_items.unit_price",
    ),
}


def test_bad_invoices_are_set_aside(spark, tmp_path):
    rows = [row for row, _ in BAD_INVOICES.values()]
    path = write(tmp_path, "invoices", rows + INVOICES[:1])
    loaded = scan(spark, "invoices", path, strict_dates=True)
    bad = [[v.rule for v in r.violations] for r in loaded.quarantine.collect()]
    expected = [rule for _, rule in BAD_INVOICES.values()]
    assert [len(rules) for rules in bad] == [1] * len(expected)
    assert [rules[0] for rules in bad] == expected
    audit = validation.load_audit(loaded.checked, "invoices", strict_dates=True).first()
    assert (audit.total_rows, audit.valid_rows, audit.skipped_rows) == (len(rows) + 1, 1, len(rows))


def test_an_id_may_not_end_in_a_line_break(spark):
    ids = spark.createDataFrame([("INV-500001",), ("INV-500001\n",)], "id string")
    checked = ids.selectExpr(validation.matches("id", validation.INVOICE_ID) + " AS good")
    assert [r.good for r in checked.collect()] == [True, False]


def test_lenient_lines(spark, tmp_path):
    texts = {
        "INV-500001": """"[{'sku': 'SKU-AAAA', 'description': None, 'quantity': 3, 'unit_price': 2.5}]\"""",
        "INV-500002": '"[{""sku"": ""SKU-AAAA"", ""quantity"": ""3"", ""unit_price"": ""2.5""}]"',
        "INV-500003": '"[{""sku"": ""SKU-AAAA"", ""quantity"": 3.7, ""unit_price"": 2.5}]"',
    }
    rows = [f"{key},CUST-7001,2024-03-01,,{text},10,0,USD,OPEN," for key, text in texts.items()]
    valid = scan(spark, "invoices", write(tmp_path, "invoices", rows)).valid.collect()
    assert [(r.line_items[0].quantity, r.line_items[0].unit_price) for r in valid] == [(3, Decimal("2.5"))] * 3


@pytest.mark.parametrize(("written", "read"), [
    ("3", 3), ('""3""', 3), ('"" 4 ""', 4), ("2.7", 2), ("1e2", 100), ("true", 1),
    ('""2.7""', None), ('""1e2""', None), ("0.9", None), ("-2.9", None), ("false", None), ("null", None),
    ("[1]", None), ("99999999999", None), ("1e30", None), ('""x""', None),
])
def test_a_quantity_is_read_by_its_type(spark, tmp_path, written, read):
    rows = [f'INV-500001,CUST-7001,2024-03-01,,"[{{""sku"": ""SKU-AAAA"", ""quantity"": {written}, '
            '""unit_price"": 2.5}]",10,0,USD,OPEN,']
    loaded = scan(spark, "invoices", write(tmp_path, "invoices", rows))
    assert [r.line_items[0].quantity for r in loaded.valid.collect()] == ([] if read is None else [read])
    assert [[v.rule for v in r.violations] for r in loaded.quarantine.collect()] == (
        [["line_items.quantity"]] if read is None else [])


def test_bad_payments(spark, tmp_path):
    rows = [
        "PMT-600001,INV-500001,CUST-7001,2024-03-05,0,ACH,,CLEARED,",
        "PMT-600002,INV-500001,CUST-7001,2024-03-05,-1,ACH,,CLEARED,",
        "PMT-600003,INV-500001,CUST-7001,2024-02-30,1,BARTER,,GONE,",
    ]
    bad = scan(spark, "payments", write(tmp_path, "payments", rows)).quarantine.collect()
    assert [[v.rule for v in r.violations] for r in bad] == [
        ["amount_paid"], ["amount_paid"], ["payment_date", "payment_method", "status"],
    ]


def test_columns_by_name_and_missing_currency(spark, tmp_path):
    header = "customer_id,invoice_id,order_date,line_items,total_amount,status"
    path = write(tmp_path, "invoices", [f"CUST-7001,INV-500001,2024-03-01,{LINE},5,OPEN"], header)
    row = scan(spark, "invoices", path).valid.first()
    assert (row.invoice_id, row.currency, row.amount_paid) == ("INV-500001", "USD", Decimal("0.00"))


def test_other_header_in_one_folder_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_text(spark, str(tmp_path)).collect()


def test_duplicate_invoices_keep_the_last(spark, tmp_path):
    rows = [
        f"INV-500001,CUST-7001,2024-03-09,,{LINE},10,0,USD,OPEN,",
        f"INV-500001,CUST-7002,2024-03-01,,{LINE},20,0,USD,OPEN,",
    ]
    invoices = scan(spark, "invoices", write(tmp_path, "invoices", rows)).valid
    pays = scan(spark, "payments", write(tmp_path, "payments", PAYMENTS[:1])).valid
    rets = scan(spark, "returns", write(tmp_path, "returns", [])).valid
    found = detect(invoices, pays, rets)
    (match,) = found.matches.collect()
    assert (match.customer_id, match.invoice_total) == ("CUST-7002", Decimal("20.00"))
    broken = validation.constraint_violations({"ar_invoices": invoices}).collect()
    assert [(r.constraint_name, r.row_key) for r in broken] == [("pk_ar_invoices", "INV-500001")]


def test_schema_errors_in_path_order(spark):
    records = spark.createDataFrame(
        [("RET-1", "INV-500001", None, "2024-01-01", [("SKU-AAAA", "bad", "x", "1", None)], "OTHER", "GONE")],
        "return_id string, original_invoice_id string, customer_id string, return_date string, line_items "
        "array<struct<original_sku:string,returned_sku:string,quantity:string,unit_price:string,notes:string>>, "
        "reason_code string, status string",
    )
    row = validation.schema_violations(records, "returns").first()
    assert (row.first_path, row.first_rule, row.total_errors) == ("line_items/0/quantity", "type", 4)
    extra = records.selectExpr("*", "'?' AS colour").drop("reason_code")
    row = validation.schema_violations(extra, "returns").first()
    assert (row.first_path, row.first_rule, row.total_errors) == ("", "required", 6)


def test_pipeline_and_rerun(spark, tmp_path):
    rows = {"invoices": INVOICES, "payments": PAYMENTS, "returns": []}
    sources = {name: write(tmp_path, name, rows[name]) for name in rows}
    archive = str(tmp_path / "archive")
    day = datetime.date(2024, 6, 1)
    for _ in range(2):
        run = run_pipeline(spark, sources, day, archive=archive)
        summary = run.summary.first()
    assert (summary.invoices_processed, summary.payments_processed, summary.returns_processed) == (5, 5, 0)
    assert (summary.overpayments_detected, summary.underpayments_detected, summary.fraud_alerts) == (1, 2, 0)
    assert summary.pipeline_success and summary.total_duration_seconds > 0
    assert spark.read.parquet(f"{archive}/ar_reconciliation_results").count() == 3
    assert spark.read.parquet(f"{archive}/ar_pipeline_run_summary").count() == 1


def test_pipeline_survives_a_missing_source(spark, tmp_path):
    sources = {"invoices": write(tmp_path, "invoices", INVOICES), "payments": str(tmp_path / "none.csv"),
               "returns": str(tmp_path / "none.csv")}
    run = run_pipeline(spark, sources, datetime.date(2024, 6, 1))
    summary = run.summary.first()
    assert run.outcome == "PARTIAL" and len(run.errors) == 2
    assert summary.pipeline_success and summary.payments_processed == 0
    nothing = run_pipeline(spark, dict.fromkeys(sources, str(tmp_path / "none.csv")), datetime.date(2024, 6, 1))
    assert nothing.outcome == "FAILED" and not nothing.summary.first().pipeline_success


def test_pipeline_reports_a_bad_file_and_a_failing_stage(spark, tmp_path, monkeypatch):
    from remitmatch.plans import pipeline

    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADERS["payments"], *PAYMENTS]) + "\n")
    (folder / "b.csv").write_text("other,header\n1,2\n")
    sources = {"invoices": write(tmp_path, "invoices", INVOICES), "payments": str(folder),
               "returns": str(tmp_path / "none.csv")}
    archive = str(tmp_path / "archive")
    run = run_pipeline(spark, sources, datetime.date(2024, 6, 1), "bad-file", archive=archive)
    assert run.outcome == "PARTIAL" and [e.split(":")[0] for e in run.errors] == ["load payments", "load returns"]

    def broken(*_):
        raise RuntimeError("no detection today")

    monkeypatch.setattr(pipeline, "detect", broken)
    sources["payments"] = write(tmp_path, "payments", PAYMENTS)
    failed = run_pipeline(spark, sources, datetime.date(2024, 6, 1), "broken", archive=archive)
    assert failed.outcome == "FAILED" and "no detection today" in failed.errors[-1]
    kept = {r.pipeline_run_id: r for r in spark.read.parquet(f"{archive}/ar_pipeline_run_summary").collect()}
    assert set(kept) == {"bad-file", "broken"}
    assert not kept["broken"].pipeline_success and "FAILED" in kept["broken"].notes
    assert kept["broken"].payments_processed > 0 and kept["bad-file"].pipeline_success


def test_unreadable_dates_keep_the_record(spark, tmp_path):
    path = write(tmp_path, "payments", ["PMT-600001,INV-500001,CUST-9999,2024-13-05,100.50,ACH,R1,CLEARED,"])
    part = scan(spark, "payments", path)
    assert part.valid.first().payment_date is None and part.quarantine.count() == 0
    assert [v.rule for v in part.checked.first().violations] == ["payment_date"]
    assert scan(spark, "payments", path, strict_dates=True).valid.count() == 0
