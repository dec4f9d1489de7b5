"""The document pipeline as five stages with a ledger, resumable after the last good one.

Every stage reads what the stages before wrote and writes its own results under
``<root>/stages/<run id>/<stage>``; when it ends, a row goes to the ledger: status, rows, errors, seconds. A
rerun of the same run id with the same inputs starts behind the last stage that ended well, so a failure
late in the run costs no second parse. Other inputs under the same id start from the beginning.

=============== ======================================================= ===============================
stage           writes                                                  PARTIAL / FAILED
=============== ======================================================= ===============================
ingestion       each source parsed and checked, read once               some / all sources unreadable
validation      payments and returns that name unknown invoices         any of them / an error
transformation  the discrepancy list                                    - / an error, the run ends
reporting       aging, its bucket counts, high-risk customers           - / an error
archival        results (resolutions kept), report and run summary      - / an error
=============== ======================================================= ===============================

Orphans make validation PARTIAL and change nothing else. ``publish=False`` leaves archival out (SKIPPED).
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitmatch.operators.aging import aging_bucket_counts
from remitmatch.operators.discrepancies import high_risk_accounts
from remitmatch.plans.pipeline import COUNTED, detect
from remitmatch.schemas import DOCUMENT_CSV
from remitmatch.session import PACKED
from remitmatch.sinks.outputs import merge_run, results_rows, summary_row, write_report, write_summary
from remitmatch.sources.documents import read_csv_text, read_documents, split

STAGES = ("ingestion", "validation", "transformation", "reporting", "archival")
GOOD = ("SUCCESS", "PARTIAL", "SKIPPED")
ENTITIES = ("invoices", "payments", "returns")
LEDGER = ("position int, status string, rows bigint, errors array<string>, seconds double, inputs string, "
          "finished_at timestamp, pipeline_run_id string, stage string")


class Outcome(NamedTuple):
    """How a stage ended: rows processed, and what went wrong without stopping it."""

    rows: int
    errors: list[str]
    status: str


def ledger(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """The stage results of all runs, or of one."""
    try:
        rows = spark.read.schema(LEDGER).parquet(f"{root}/stage_ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows if run_id is None else rows.where(F.col("pipeline_run_id") == run_id)


def _said(error: Exception) -> str:
    return f"{type(error).__name__}: {str(error).splitlines()[0][:300] if str(error) else ''}"


class StagedRun:
    """One run's stages over its folder."""

    def __init__(self, spark: SparkSession, sources: dict[str, str], run_date: datetime.date, run_id: str,
                 root: str, as_of: datetime.date | None, environment: str, publish: bool, multiline: bool):
        self.spark, self.sources, self.run_date, self.run_id = spark, sources, run_date, run_id
        self.root, self.as_of, self.environment = root, as_of, environment
        self.publish, self.multiline = publish, multiline
        self.folder = f"{root}/stages/{run_id}"
        self.started = time.monotonic()

    def _write(self, stage: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{stage}/{name}"
        df.write.mode("overwrite").parquet(path, compression=PACKED)
        return self.spark.read.schema(df.schema).parquet(path)

    def _read(self, stage: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{stage}/{name}")

    def loaded(self, entity: str) -> DataFrame:
        """The good records of a source, typed; the rest is in ``quarantine``."""
        extra = ["load_order"] if entity == "invoices" else None
        return split(self._read("ingestion", entity), entity, extra).valid

    def quarantine(self, entity: str) -> DataFrame:
        return split(self._read("ingestion", entity), entity).quarantine

    def _detected(self):
        return detect(*[self.loaded(e) for e in ENTITIES], self.as_of)

    def ingestion(self) -> Outcome:
        errors = []
        for entity in ENTITIES:
            place = ["struct(_metadata.file_path, _metadata.file_block_start, monotonically_increasing_id() AS row)"
                     " AS load_order"] if entity == "invoices" else []
            extra = ["load_order"] if place else None
            try:
                raw = read_csv_text(self.spark, self.sources[entity], self.multiline).selectExpr("*", *place)
                self._write("ingestion", entity, read_documents(raw, entity, extra))
            except Exception as error:  # an unreadable source counts as empty
                errors.append(f"{entity}: {_said(error)}")
                nothing = self.spark.createDataFrame([], DOCUMENT_CSV[entity])
                if place:
                    nothing = nothing.selectExpr(
                        "*", "named_struct('file_path', '', 'file_block_start', 0L, 'row', 0L) AS load_order")
                self._write("ingestion", entity, read_documents(nothing, entity, extra))
        rows = sum(self.loaded(e).count() for e in ENTITIES)
        return Outcome(rows, errors, "FAILED" if len(errors) == len(ENTITIES) else "PARTIAL" if errors else "SUCCESS")

    def validation(self) -> Outcome:
        found = self._detected()
        errors = []
        for name, orphans, kind in (("orphan_payments", found.orphan_payments, "payments"),
                                    ("orphan_returns", found.orphan_returns, "returns")):
            n = self._write("validation", name, orphans).count()
            if n:
                errors.append(f"{n} {kind} reference unknown invoices")
        rows = sum(self.loaded(e).count() for e in ENTITIES)
        return Outcome(rows, errors, "PARTIAL" if errors else "SUCCESS")

    def transformation(self) -> Outcome:
        report = self._write("transformation", "discrepancy_report", self._detected().report)
        return Outcome(report.count(), [], "SUCCESS")

    def reporting(self) -> Outcome:
        aging = self._write("reporting", "aging_report", self._detected().aging)
        self._write("reporting", "aging_bucket_counts", aging_bucket_counts(aging))
        report = self._read("transformation", "discrepancy_report")
        self._write("reporting", "high_risk_accounts", high_risk_accounts(report))
        return Outcome(self.loaded("invoices").count(), [], "SUCCESS")

    def archival(self) -> Outcome:
        if not self.publish:
            return Outcome(0, [], "SKIPPED")
        report = self._read("transformation", "discrepancy_report")
        write_report(report, self.root, self.run_date, compression="gzip")
        rows = results_rows(report, self.run_id, self.run_date, self.environment)
        merge_run(self.spark, rows, self.root, self.run_date, self.run_id)
        counts = report.agg(*[F.count_if(F.expr(test)).alias(c) for c, test in COUNTED.items()]).withColumns(
            {"high_risk_customers": F.lit(self._read("reporting", "high_risk_accounts").count())}
            | {f"{e}_processed": F.lit(self.loaded(e).count()) for e in ENTITIES})
        write_summary(summary_row(
            counts, self.run_id, self.environment, True, time.monotonic() - self.started), self.root, self.run_id)
        return Outcome(report.count(), [], "SUCCESS")


def run_stages(
    spark: SparkSession, sources: dict[str, str], run_date: datetime.date, run_id: str, root: str,
    as_of: datetime.date | None = None, environment: str = "dev", publish: bool = True, multiline: bool = True,
    work: dict[str, Callable[[StagedRun], Outcome]] | None = None,
) -> DataFrame:
    """Run the stages that this run id still lacks; returns the run's ledger.

    ``work`` replaces stages by name. A failed ingestion or transformation ends the run; other stages' errors
    are recorded and the next stage runs.
    """
    run = StagedRun(spark, sources, run_date, run_id, root, as_of, environment, publish, multiline)
    inputs = json.dumps([sources, str(run_date), str(as_of), environment, publish], sort_keys=True)
    done = {r["stage"]: r for r in ledger(spark, root, run_id).collect()}  # five rows at most
    first = 0
    while first < len(STAGES) and (row := done.get(STAGES[first])) and row["status"] in GOOD and row["inputs"] == inputs:
        first += 1
    for stale in STAGES[first:]:
        if stale in done:
            _forget(spark, f"{root}/stage_ledger/pipeline_run_id={run_id}/stage={stale}")
    for position in range(first, len(STAGES)):
        name, began = STAGES[position], time.monotonic()
        try:
            outcome = (work or {}).get(name, getattr(StagedRun, name))(run)
        except Exception as error:  # a stage's failure is the run's to report
            outcome = Outcome(0, [_said(error)], "FAILED")
        row = (position + 1, outcome.status, outcome.rows, outcome.errors, time.monotonic() - began, inputs,
               datetime.datetime.now(datetime.UTC))
        spark.createDataFrame([row], LEDGER.rsplit(", pipeline_run_id", 1)[0]).write.mode("overwrite").parquet(
            f"{root}/stage_ledger/pipeline_run_id={run_id}/stage={name}")
        if outcome.status == "FAILED" and name in ("ingestion", "transformation"):
            break
    return ledger(spark, root, run_id)


def _forget(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
