"""Flat tables, links, warehouse windows, snapshots and the daily drop."""

import datetime
import random
from decimal import Decimal

import duckdb
import pytest

from remitmatch.operators.instalments import partial_payment_analysis, running_payments
from remitmatch.operators.links import payment_invoice_links
from remitmatch.operators.validation import currency_check, flat_fk_violations
from remitmatch.schemas import DOCUMENT_CSV
from remitmatch.session import scratch_path
from remitmatch.settings import DEFAULT, PRESETS, Setting, active_settings, config_table
from remitmatch.sinks import outputs
from remitmatch.sources import drops, flat_csv
from remitmatch.streaming import daily_drop


def test_links(spark):
    notes = [
        (1, "INV12 + INV13 less credit"), (2, "inv0013, INV13 again"), (3, "XINV9 INV9X INV"),
        (4, None), (5, "INV99999999999999999999 INV7"),
    ]
    rows = payment_invoice_links(spark.createDataFrame(notes, "payment_id long, reference_notes string"))
    assert sorted((r.payment_id, r.invoice_id) for r in rows.collect()) == [(1, 12), (1, 13), (2, 13), (5, 7)]


def test_flat_load_by_header(spark, tmp_path):
    (tmp_path / "credits.csv").write_text(
        "credit_amount,credit_id,applied_invoice_id\n10.50,1,12.0\n3,2,\nbad,3,x\n"
    )
    rows = flat_csv.load_flat(spark, "credits", str(tmp_path / "credits.csv")).collect()
    assert [(r.credit_id, r.credit_amount, r.applied_invoice_id, r.customer_id) for r in rows] == [
        (1, Decimal("10.50"), 12, None), (2, Decimal("3.00"), None, None), (3, None, None, None),
    ]
    (tmp_path / "wrong.csv").write_text("colour\nred\n")
    with pytest.raises(ValueError, match="unexpected header"):
        flat_csv.load_flat(spark, "credits", str(tmp_path / "wrong.csv"))


def test_foreign_key(spark):
    invoices = spark.sql("SELECT * FROM VALUES (1L, 10L), (2L, 11L), (3L, NULL) AS t(invoice_id, customer_id)")
    customers = spark.sql("SELECT 10L AS customer_id")
    assert [r.invoice_id for r in flat_fk_violations(invoices, customers).collect()] == [2]


def test_currency_codes(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 'nzd'), ('b', 'KRW'), ('c', 'XYZ'), ('d', NULL) AS t(id, currency)")
    assert [r.is_known for r in currency_check(rows, "id").collect()] == [True, True, False, False]


def test_settings(spark):
    stored = config_table(spark, PRESETS)
    assert stored.count() == 4
    one = config_table(spark, [Setting("x", 30, Decimal("5.00"))]).selectExpr("1 AS id", "*")
    assert active_settings(one) == [Setting("active", 30, Decimal("5.00"))]
    assert active_settings(one.where("id = 2")) == []
    assert DEFAULT[1:] == (60, Decimal("50.00"))


def warehouse(spark, seed=3):
    """One invoice with a third of all payments, some dates crowded, ids of mixed length."""
    rng = random.Random(seed)
    invoices = [(f"INV-{i}", f"C{i % 5}", Decimal(rng.randint(0, 4000)) / 100, rng.choice(["OPEN", "VOID", "PAID"])) for i in range(40)]
    invoices[0] = ("INV-0", "C0", Decimal("99999.00"), "OPEN")
    paid = []
    for i in range(600):
        hot = rng.random() < 0.35
        paid.append((
            f"PMT-{rng.randint(1, 10) ** rng.randint(1, 9) + i * 7}", "INV-0" if hot else f"INV-{rng.randint(1, 45)}",
            datetime.date(2024, 1, 1) + datetime.timedelta(days=0 if hot and rng.random() < 0.5 else rng.randint(0, 9)),
            Decimal(rng.randint(1, 900)) / 100, rng.choice(["CLEARED", "PARTIAL", "FAILED"]),
        ))
    paid = list({p[0]: p for p in paid}.values())
    inv = spark.createDataFrame(invoices, "invoice_id string, customer_id string, total_amount decimal(18,2), status string")
    inv = inv.selectExpr("*", "DATE'2024-01-01' AS order_date", "DATE'2024-01-31' AS due_date", "'USD' AS currency")
    pay = spark.createDataFrame(paid, "payment_id string, invoice_id string, payment_date date, amount_paid decimal(18,2), status string")
    return invoices, paid, inv, pay.selectExpr("*", "'ACH' AS payment_method", "'r' AS reference_number")


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_running_payments_against_brute_force(spark, parts):
    invoices, paid, inv, pay = warehouse(spark)
    con = duckdb.connect()
    con.execute("CREATE TABLE i (invoice_id VARCHAR, c VARCHAR, total DECIMAL(18,2), status VARCHAR)")
    con.execute("CREATE TABLE p (payment_id VARCHAR, invoice_id VARCHAR, d DATE, amount DECIMAL(18,2), status VARCHAR)")
    con.executemany("INSERT INTO i VALUES (?, ?, ?, ?)", invoices)
    con.executemany("INSERT INTO p VALUES (?, ?, ?, ?, ?)", paid)
    expected = con.execute(
        """SELECT payment_id, sum(amount) OVER (PARTITION BY invoice_id ORDER BY d, payment_id ROWS UNBOUNDED PRECEDING)
           FROM p JOIN i USING (invoice_id) WHERE p.status <> 'FAILED' AND i.status <> 'VOID' AND invoice_id IN (
             SELECT invoice_id FROM p JOIN i USING (invoice_id) WHERE p.status <> 'FAILED'
             GROUP BY invoice_id, total HAVING sum(amount) < total)"""
    ).fetchall()
    got = running_payments(inv, pay, parts).select("payment_id", "running_total_paid").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert len(got) > 100


def test_percentage_rounds_half_up(spark):
    inv = spark.sql(
        """SELECT id AS invoice_id, 'c' AS customer_id, DATE'2024-01-01' AS order_date, NULL AS due_date, total AS total_amount,
           'USD' AS currency, 'OPEN' AS status
           FROM VALUES ('a', 800.00BD), ('b', 0.00BD), ('c', 3.00BD) AS t(id, total)"""
    )
    pay = spark.sql(
        """SELECT id AS invoice_id, paid AS amount_paid, 'CLEARED' AS status, DATE'2024-01-01' AS payment_date
           FROM VALUES ('a', 1.00BD), ('b', 1.00BD), ('c', 2.00BD) AS t(id, paid)"""
    )
    rows = {r.invoice_id: r for r in partial_payment_analysis(inv, pay, datetime.date(2024, 6, 1)).collect()}
    assert rows["a"].pct_paid == Decimal("0.13")  # 0.125
    assert rows["b"].pct_paid == 0 and rows["b"].payment_classification == "FULLY_PAID"
    assert rows["c"].pct_paid == Decimal("66.67")


def test_snapshot_rerun_replaces_its_own_date(spark, tmp_path):
    table = str(tmp_path)
    rows = spark.range(5)
    outputs.write_snapshot(rows, table, "history", "2024-01-01")
    path = outputs.write_snapshot(rows, table, "history", "2024-01-08")
    outputs.write_snapshot(rows.where("id < 2"), table, "history", "2024-01-08")
    counts = {str(r.run_date): r["count"] for r in spark.read.parquet(path).groupBy("run_date").count().collect()}
    assert counts == {"2024-01-01": 5, "2024-01-08": 2}


def test_results_rerun_drops_kinds_that_are_gone(spark, tmp_path):
    report = spark.sql(
        """SELECT * FROM VALUES ('OVERPAYMENT', 'PMT-1', 'C', 'INV-1', 1.0000BD, 'd', 'OVERPAYMENT'),
           ('SKU_MISMATCH', 'RET-1', 'C', 'INV-1', 600.0000BD, 'd', 'FRAUD')
           AS t(discrepancy_type, entity_id, customer_id, reference_id, amount, detail, classification)"""
    )
    first = outputs.results_rows(report, "r", "2024-01-01")
    outputs.write_results(first, str(tmp_path), "2024-01-01", "r")
    ids = {r.result_id for r in outputs.read_results(spark, str(tmp_path)).collect()}
    assert len(ids) == 2
    again = outputs.results_rows(report.where("classification = 'FRAUD'"), "r", "2024-01-01")
    outputs.write_results(again, str(tmp_path), "2024-01-01", "r")
    (row,) = outputs.read_results(spark, str(tmp_path)).collect()
    assert row.is_fraud_alert and row.result_id in ids and str(row.run_date) == "2024-01-01"
    other = outputs.results_rows(report, "20", "2024-01-01")
    outputs.write_results(other, str(tmp_path), "2024-01-01", "20")
    runs = [r.pipeline_run_id for r in outputs.read_results(spark, str(tmp_path)).collect()]
    assert sorted(runs) == ["20", "20", "r"]


def test_each_drop_is_taken_in_once(spark, tmp_path):
    root, target, checkpoint = str(tmp_path), str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    payments = spark.sql(
        """SELECT concat('PMT-', 600000 + id) AS payment_id, 'INV-500001' AS invoice_id, 'CUST-7001' AS customer_id,
           '2024-01-01' AS payment_date, '1.00' AS amount_paid, 'ACH' AS payment_method, CAST(NULL AS STRING) AS reference_number,
           'CLEARED' AS status, CAST(NULL AS STRING) AS notes FROM range(6)"""
    )
    seen = []
    for run_date in ("2024-01-01", "2024-01-02", None):
        if run_date:
            outputs.export_csv(payments, drops.drop_path(root, "payments", run_date))
        daily_drop.ingest(daily_drop.drop_stream(spark, root, "payments"), target, checkpoint).awaitTermination()
        seen.append(spark.read.parquet(target).count())
    assert seen == [6, 12, 12]
    batch = drops.read_drops(spark, root, "payments", ["2024-01-02"])
    assert {str(r.run_date) for r in batch.collect()} == {"2024-01-02"}


def test_exports_read_back_unchanged(spark, tmp_path):
    notes = ["first\nsecond", '"quoted", twice', "  padded  ", "back\\slash", "a,b", "tab\t", " ", 'end"', "cr\r\nlf"]
    rows = spark.createDataFrame([(str(i), n) for i, n in enumerate(notes)], "id string, notes string")
    outputs.export_csv(rows, str(tmp_path / "out"))
    back = flat_csv.read_csv_text(spark, str(tmp_path / "out"))
    assert {r.id: r.notes for r in back.collect()} == dict((str(i), n) for i, n in enumerate(notes))


def test_drop_dates_come_from_the_last_folder(spark, tmp_path):
    root = str(tmp_path / "2020-02-02")
    rows = spark.createDataFrame([("PMT-1", "line one\nline two")], "payment_id string, notes string")
    layout = [c for c in DOCUMENT_CSV["payments"].fieldNames() if c not in rows.columns]
    rows = rows.selectExpr("payment_id", *[f"CAST(NULL AS STRING) AS {c}" for c in layout], "notes")
    rows = rows.select(*DOCUMENT_CSV["payments"].fieldNames())
    outputs.export_csv(rows, drops.drop_path(root, "payments", "2024-01-01"))
    outputs.export_csv(rows, drops.drop_path(root, "payments", "incoming_tmp"))
    target = str(tmp_path / "landed")
    daily_drop.ingest(daily_drop.drop_stream(spark, root, "payments"), target, str(tmp_path / "check")).awaitTermination()
    landed = spark.read.parquet(target).collect()
    assert {str(r.run_date) for r in landed} == {"2024-01-01", "None"}
    assert {r.notes for r in landed} == {"line one\nline two"}
    assert [str(r.run_date) for r in drops.read_drops(spark, root, "payments", ["2024-01-01"]).collect()] == ["2024-01-01"]


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(shared) and first != second
