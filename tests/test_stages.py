"""The staged run: its ledger, what a failure leaves, and where a rerun starts."""

import datetime

from test_documents import INVOICES, PAYMENTS, write

from remitmatch.plans import stages

DAY = datetime.date(2024, 6, 1)


def ran(df):
    return {r.stage: (r.status, r.rows, list(r.errors)) for r in df.orderBy("position").collect()}


def parts(root, stage):
    return sorted((p, p.stat().st_mtime_ns) for p in (root / "stages/r" / stage).rglob("*.parquet"))


def test_a_failed_stage_is_resumed(spark, tmp_path):
    root = tmp_path / "archive"
    sources = {n: write(tmp_path, n, rows) for n, rows in
               (("invoices", INVOICES), ("payments", PAYMENTS), ("returns", []))}

    def broken(_):
        raise RuntimeError("lost in stage 3")

    first = ran(stages.run_stages(spark, sources, DAY, "r", str(root), DAY, work={"transformation": broken}))
    assert list(first) == ["ingestion", "validation", "transformation"]
    assert first["ingestion"] == ("SUCCESS", 10, [])
    assert first["validation"] == ("PARTIAL", 10, ["1 payments reference unknown invoices"])
    assert first["transformation"] == ("FAILED", 0, ["RuntimeError: lost in stage 3"])
    before = parts(root, "ingestion")
    again = ran(stages.run_stages(spark, sources, DAY, "r", str(root), DAY))
    assert [s for s, _, _ in again.values()] == ["SUCCESS", "PARTIAL", "SUCCESS", "SUCCESS", "SUCCESS"]
    assert again["transformation"][1] == 3 and again["archival"][1] == 3
    assert parts(root, "ingestion") == before
    assert spark.read.parquet(str(root / "ar_pipeline_run_summary")).first().payments_processed == 5
    # nothing is left to do; another input under the same id starts from the beginning
    assert ran(stages.run_stages(spark, sources, DAY, "r", str(root), DAY, work={"ingestion": broken})) == again
    fresh = ran(stages.run_stages(spark, sources, DAY, "r", str(root), DAY, publish=False))
    assert fresh["archival"] == ("SKIPPED", 0, []) and parts(root, "ingestion") != before


def test_unreadable_sources(spark, tmp_path):
    gone = str(tmp_path / "none.csv")
    sources = {"invoices": write(tmp_path, "invoices", INVOICES), "payments": gone, "returns": gone}
    got = ran(stages.run_stages(spark, sources, DAY, "p", str(tmp_path / "a"), DAY))
    assert got["ingestion"][0] == "PARTIAL" and len(got["ingestion"][2]) == 2
    assert got["transformation"] == ("SUCCESS", 0, []) and got["reporting"][1] == 5
    failed = ran(stages.run_stages(spark, dict.fromkeys(sources, gone), DAY, "f", str(tmp_path / "a"), DAY))
    assert list(failed) == ["ingestion"] and failed["ingestion"][0] == "FAILED"
    assert stages.ledger(spark, str(tmp_path / "a")).count() == 6
    assert stages.ledger(spark, str(tmp_path / "nowhere")).count() == 0


def test_a_failed_report_does_not_stop_the_run(spark, tmp_path):
    sources = {n: write(tmp_path, n, rows) for n, rows in
               (("invoices", INVOICES), ("payments", PAYMENTS), ("returns", []))}

    def broken(_):
        raise RuntimeError("no report")

    got = ran(stages.run_stages(spark, sources, DAY, "q", str(tmp_path / "a"), DAY, work={"reporting": broken}))
    assert got["reporting"][0] == "FAILED" and got["archival"][0] == "FAILED"
    assert ran(stages.run_stages(spark, sources, DAY, "q", str(tmp_path / "a"), DAY))["archival"][0] == "SUCCESS"
