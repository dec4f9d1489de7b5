"""Corrected drops, and findings that stay resolved from run to run."""

import datetime

import pytest

from remitmatch.sinks import outputs
from remitmatch.sources import drops
from remitmatch.streaming import intake

PAYMENTS = """SELECT concat('PMT-', 600000 + id) AS payment_id, 'INV-500001' AS invoice_id, 'CUST-7001' AS customer_id,
    '2024-01-01' AS payment_date, '{0}' AS amount_paid, 'ACH' AS payment_method, CAST(NULL AS STRING) AS reference_number,
    'CLEARED' AS status, 'line one\nline two' AS notes FROM range({1})"""


@pytest.fixture
def drop(spark, tmp_path):
    root = str(tmp_path / "raw")

    def put(run_date, price, count):
        rows = spark.sql(PAYMENTS.format(price, count))
        outputs.export_csv(rows, drops.drop_path(root, "payments", run_date))

    def run():
        done = intake.take_in(spark, root, "payments", f"{root}/landed", f"{root}/log")
        return {str(r.run_date): (r.action, r.files) for r in done.collect()}

    def landed():
        rows = spark.read.parquet(f"{root}/landed").collect()
        return sorted((str(r.run_date), r.payment_id, r.amount_paid) for r in rows)

    return put, run, landed


def test_a_rewritten_drop_replaces_its_date(drop):
    put, run, landed = drop
    put("2024-01-01", "10.00", 3)
    put("2024-01-02", "5.00", 2)
    first = run()
    assert {d: a for d, (a, _) in first.items()} == {"2024-01-01": "new", "2024-01-02": "new"}
    assert run() == {}
    before = landed()
    put("2024-01-01", "99.00", 2)
    put("2024-01-02", "5.00", 2)  # sent again as it was
    assert {d: a for d, (a, _) in run().items()} == {"2024-01-01": "replaced", "2024-01-02": "same"}
    assert landed() == [("2024-01-01", f"PMT-60000{i}", "99.00") for i in range(2)] + before[3:]
    assert run() == {}
    put("2024-01-03", "1.00", 1)
    assert {d: a for d, (a, _) in run().items()} == {"2024-01-03": "new"}


def test_an_emptied_drop_empties_its_date(drop):
    put, run, landed = drop
    put("2024-01-01", "10.00", 3)
    put("no_date", "7.00", 1)
    run()
    assert {d for d, _, _ in landed()} == {"2024-01-01", "None"}
    put("2024-01-01", "10.00", 0)
    put("no_date", "8.00", 1)
    assert {d: a for d, (a, _) in run().items()} == {"2024-01-01": "replaced", "None": "replaced"}
    assert landed() == [("None", "PMT-600000", "8.00")]


def test_a_lost_run_is_made_up_for(spark, drop, tmp_path):
    """Data written, log not: the next run replaces the date again, without doubling it."""
    put, run, landed = drop
    put("2024-01-01", "10.00", 3)
    run()
    before = landed()
    put("2024-01-01", "11.00", 4)
    seen = intake.read_log(spark, str(tmp_path / "raw/log"))
    assert seen.count() >= 1
    spark.sql(PAYMENTS.format("11.00", 4)).write.mode("overwrite").parquet(
        str(tmp_path / "raw/landed/run_date=2024-01-01"))
    assert run()["2024-01-01"][0] == "replaced"
    assert len(landed()) == 4 and landed() != before


REPORT = """SELECT * FROM VALUES
    ('OVERPAYMENT', 'PMT-1', 'C', 'INV-1', 1.0000BD, 'd', 'OVERPAYMENT'),
    ('OVERPAYMENT', 'PMT-2', 'C', 'INV-2', 2.0000BD, 'd', 'OVERPAYMENT'),
    ('SKU_MISMATCH', 'RET-1', CAST(NULL AS STRING), 'INV-1', 600.0000BD, 'd', 'FRAUD'),
    ('SKU_MISMATCH', 'RET-1', CAST(NULL AS STRING), 'INV-1', 600.0000BD, 'd', 'FRAUD')
    AS t(discrepancy_type, entity_id, customer_id, reference_id, amount, detail, classification)"""


def resolution(spark, ids, by, at="2024-01-05 00:00:00"):
    rows = [(i, datetime.datetime.fromisoformat(at), by, None) for i in ids]
    return spark.createDataFrame(
        rows, "result_id long, resolved_at timestamp, resolved_by string, resolution_notes string")


def state(spark, root):
    return sorted(
        (r.pipeline_run_id, r.entity_id, r.is_resolved, r.resolved_by) for r in outputs.read_results(spark, root).collect())


def ids_of(spark, root, run_id, entity):
    rows = outputs.read_results(spark, root).where(f"pipeline_run_id = '{run_id}' AND entity_id = '{entity}'")
    return sorted({r.result_id for r in rows.collect()})


def test_resolved_findings_stay_resolved(spark, tmp_path):
    root, report = str(tmp_path), spark.sql(REPORT)

    def run(run_id, run_date, rows=report):
        outputs.merge_run(spark, outputs.results_rows(rows, run_id, run_date), root, run_date, run_id)

    run("a", "2024-01-01")
    assert {r[2] for r in state(spark, root)} == {False}
    untouched = sorted((tmp_path / "ar_reconciliation_results").rglob("discrepancy_type=OVERPAYMENT/*.parquet"))
    outputs.resolve_results(spark, root, resolution(spark, ids_of(spark, root, "a", "RET-1") + [12345], "eve"))
    assert sorted((tmp_path / "ar_reconciliation_results").rglob("discrepancy_type=OVERPAYMENT/*.parquet")) == untouched
    changed = report.withColumn("amount", report.amount + 1).where("entity_id <> 'PMT-2'")
    run("b", "2024-01-08", report.union(changed))
    assert state(spark, root) == [
        ("a", "PMT-1", False, None), ("a", "PMT-2", False, None), ("a", "RET-1", True, "eve"), ("a", "RET-1", True, "eve"),
        ("b", "PMT-1", False, None), ("b", "PMT-1", False, None), ("b", "PMT-2", False, None),
        ("b", "RET-1", False, None), ("b", "RET-1", False, None), ("b", "RET-1", True, "eve"), ("b", "RET-1", True, "eve"),
    ]
    # closing a finding closes it in later runs, not in earlier ones; the newest resolution counts
    (two,) = ids_of(spark, root, "b", "PMT-2")
    outputs.resolve_results(spark, root, resolution(spark, [two], "old", "2024-01-09 00:00:00").union(
        resolution(spark, [two], "new", "2024-01-10 00:00:00")))
    run("b", "2024-01-08")  # written again: what was resolved in it is kept
    assert [r for r in state(spark, root) if r[1] == "PMT-2"] == [("a", "PMT-2", False, None), ("b", "PMT-2", True, "new")]
    outputs.resolve_results(spark, root, resolution(spark, ids_of(spark, root, "a", "PMT-1"), "eve"))
    assert {r for r in state(spark, root) if r[1] == "PMT-1"} == {("a", "PMT-1", True, "eve"), ("b", "PMT-1", True, "eve")}


def test_no_resolutions_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    outputs.merge_run(
        spark, outputs.results_rows(spark.sql(REPORT), "a", "2024-01-01"), root, "2024-01-01", "a")
    before = state(spark, root)
    outputs.resolve_results(spark, root, resolution(spark, [], "x"))
    assert state(spark, root) == before
    outputs.merge_run(
        spark, outputs.results_rows(spark.sql(REPORT).limit(0), "e", "2024-01-02"), root, "2024-01-02", "e")
    assert state(spark, root) == before


def test_a_new_run_is_written_once(spark, tmp_path, monkeypatch):
    """Only a run that replaces its own files goes through files of its own; resolving joins all rows once."""
    aside = []
    monkeypatch.setattr(outputs, "written", lambda df, name, write=outputs.written: aside.append(name) or write(df, name))
    root, report = str(tmp_path), spark.sql(REPORT)
    for run_id, run_date in (("a", "2024-01-01"), ("b", "2024-01-08")):
        outputs.merge_run(spark, outputs.results_rows(report, run_id, run_date), root, run_date, run_id)
    assert aside == []
    outputs.resolve_results(spark, root, resolution(spark, ids_of(spark, root, "a", "PMT-1"), "eve"))
    assert aside == ["resolved"]
    outputs.merge_run(spark, outputs.results_rows(report, "b", "2024-01-08"), root, "2024-01-08", "b")
    assert aside == ["resolved", "merged"]
    assert ("b", "PMT-1", True, "eve") in state(spark, root)


def test_snapshots_start_from_one_reconciliation(spark, monkeypatch):
    from remitmatch.harness import registry

    kept = []
    monkeypatch.setattr(registry, "written", lambda df, name, write=registry.written: kept.append(name) or write(df, name))
    rows = registry.QUERIES["snapshot_roundtrip"](spark, "/root/testdata/sf0.001").count()
    assert kept == ["review"] and rows > 0


def test_rows_are_told_apart_by_a_map_of_keys(spark):
    """No row that meets a key is left out, few others are let in, and every row is in one of the two parts."""
    rows = spark.range(20000).selectExpr("id", "CASE WHEN id % 1000 <> 7 THEN xxhash64(id) END AS _key")
    keys = rows.where("id % 50 = 3 AND id < 15000").select("_key")
    met, others = outputs._met_or_not(rows, keys, 300)
    inside, outside = ([r.id for r in part.collect()] for part in (met, others))
    assert {i for i in range(15000) if i % 50 == 3} <= set(inside) and len(inside) < 300 + 1000
    assert sorted(inside + outside) == list(range(20000))
    none, everything = outputs._met_or_not(rows, keys.limit(0), 0)
    assert (none.count(), everything.count()) == (0, 20000)


def test_findings_that_share_a_key_are_told_apart(spark, tmp_path, monkeypatch):
    """One key for everything: findings are still compared in full."""
    def ran(root):
        report = spark.sql(REPORT)
        for run_id, run_date in (("a", "2024-01-01"), ("b", "2024-01-08"), ("c", "2024-01-15")):
            outputs.merge_run(spark, outputs.results_rows(report, run_id, run_date), root, run_date, run_id)
            if run_id == "b":
                outputs.resolve_results(spark, root, resolution(spark, ids_of(spark, root, "a", "RET-1"), "eve").union(
                    resolution(spark, ids_of(spark, root, "b", "PMT-1"), "bob")))
        return state(spark, root)

    want = ran(str(tmp_path / "hashed"))
    monkeypatch.setattr(outputs, "_keyed", lambda rows: rows.selectExpr("*", "7L AS _key"))
    assert ran(str(tmp_path / "shared")) == want
    assert {r[:3] for r in want if r[2]} == {
        ("a", "RET-1", True), ("b", "RET-1", True), ("c", "RET-1", True), ("b", "PMT-1", True), ("c", "PMT-1", True)}


def test_a_merge_shuffles_no_row_that_meets_no_resolution(spark, tmp_path, monkeypatch):
    """Of 1000 new findings, 10 of them resolved before, few are exchanged to be joined."""
    root = str(tmp_path)
    report = spark.range(1000).selectExpr(
        "'OVERPAYMENT' AS discrepancy_type", "concat('PMT-', id) AS entity_id", "'C' AS customer_id", "'I' AS reference_id",
        "CAST(id AS DECIMAL(28,4)) AS amount", "'d' AS detail", "'OVERPAYMENT' AS classification")
    outputs.merge_run(spark, outputs.results_rows(report, "a", "2024-01-01"), root, "2024-01-01", "a")
    ids = [r.result_id for r in outputs.read_results(spark, root).where("discrepancy_amount < 10").collect()]
    outputs.resolve_results(spark, root, resolution(spark, ids, "eve"))
    merged = []
    write = outputs.write_results
    monkeypatch.setattr(outputs, "write_results", lambda rows, *where: (merged.append(rows), write(rows, *where))[1])
    outputs.merge_run(spark, outputs.results_rows(report, "b", "2024-01-08"), root, "2024-01-08", "b")
    assert sum(r[2] for r in state(spark, root) if r[0] == "b") == 10
    plan = merged[0]._jdf.queryExecution().optimizedPlan().toString()
    left = plan[plan.index("LeftOuter"):]
    assert "bitmap_construct_agg" in plan and "Filter" in left[:left.index("Aggregate")]
