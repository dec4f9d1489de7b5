"""What a run leaves on disk: packed files instead of cached blocks, archived reports gzipped and unchanged."""

import datetime

from test_documents import INVOICES, PAYMENTS, write

from remitmatch.plans import pipeline, stages
from remitmatch.session import written
from remitmatch.sinks import outputs
from remitmatch.sources.documents import read_csv_text

DAY = datetime.date(2024, 6, 1)


def sources(folder):
    return {n: write(folder, n, rows) for n, rows in
            (("invoices", INVOICES), ("payments", PAYMENTS), ("returns", []))}


def endings(folder):
    return {p.name.rpartition("c000.")[2] for p in folder.rglob("part-*") if p.is_file()}


def reported(spark, path):
    return sorted(tuple(r) for r in read_csv_text(spark, str(path)).collect())


def test_a_pipeline_run_keeps_files_and_no_blocks(spark, tmp_path, monkeypatch):
    blocks = []
    real = outputs.write_report
    monkeypatch.setattr(pipeline, "write_report", lambda *args, **more: (
        blocks.append(spark._jsc.getPersistentRDDs().size()), real(*args, **more))[1])
    before = spark._jsc.getPersistentRDDs().size()
    run = pipeline.run_pipeline(spark, sources(tmp_path), DAY, "r", str(tmp_path / "archive"), DAY)
    assert run.outcome == "SUCCESS" and blocks == [before] * 3
    assert all(f.endswith("zstd.parquet") for df in (run.found.report, run.loaded["invoices"].checked)
               for f in df.inputFiles())
    for name in ("reports", "aging_report", "high_risk_accounts"):
        assert endings(tmp_path / "archive" / name) <= {"csv.gz"}
    plain = outputs.write_report(run.found.report, str(tmp_path / "plain"), DAY)
    assert endings(tmp_path / "plain") == {"csv"}
    rows = reported(spark, plain)
    assert len(rows) == 3 and reported(spark, tmp_path / f"archive/reports/run_date={DAY}") == rows


def test_a_staged_run_keeps_packed_files(spark, tmp_path):
    root = tmp_path / "archive"
    stages.run_stages(spark, sources(tmp_path), DAY, "r", str(root), DAY)
    assert endings(root / "reports") == {"csv.gz"}
    for folder in ("stages", "ar_reconciliation_results"):
        assert endings(root / folder) == {"zstd.parquet"}
    assert len(reported(spark, root / f"reports/run_date={DAY}")) == 3


def test_what_is_written_aside_is_packed(spark):
    assert all(f.endswith("zstd.parquet") for f in written(spark.range(3), "some").inputFiles())


def test_reporting_starts_from_what_was_written(spark, tmp_path, monkeypatch):
    """Detection is planned for validation, transformation and aging; risk and bucket counts come from their files."""
    root, planned = tmp_path / "archive", []
    monkeypatch.setattr(stages.StagedRun, "_write", lambda run, stage, name, df, write=stages.StagedRun._write: (
        planned.append((name, sorted({f.split("/stages/r/")[1].rpartition("/")[0] for f in df.inputFiles()
                                      if "/stages/r/" in f}))), write(run, stage, name, df))[1])
    stages.run_stages(spark, sources(tmp_path), DAY, "r", str(root), DAY)
    read = dict(planned)
    assert read["aging_bucket_counts"] == ["reporting/aging_report"]
    assert read["high_risk_accounts"] == ["transformation/discrepancy_report"]
