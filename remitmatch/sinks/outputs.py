"""Exports, dated snapshots, the results table and run summaries.

Everything dated is written to its own ``run_date=`` folder in overwrite mode: a rerun
replaces exactly its own date (results: its own run), also when it has fewer rows, or none, this time.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitmatch.functions.amounts import DOCUMENT_BUCKETS
from remitmatch.schemas import RESULTS, RUN_SUMMARY
from remitmatch.session import PACKED, written
from remitmatch.sources.documents import csv_options

RESULT_VIEWS = {
    "results": "recon_results_active",
    "needs_review": "recon_needs_review_active",
    "dashboard": "recon_dashboard_summary_active",
}


# How each report is ordered when it is read by people; the last column makes it unique.
REPORT_ORDER = {
    "aging_report": ["aging_sort", "customer_id", "invoice_id"],
    "aging_warehouse": ["aging_sort", "customer_id", "outstanding_balance DESC", "invoice_id"],
    "mismatch_report": ["return_date", "return_id", "original_sku"],
    "sku_mismatch_detail": [
        "is_fraud_alert DESC", "line_value DESC", "return_date DESC", "return_id", "original_sku",
    ],
    "discrepancy_report": ["discrepancy_type", "customer_id", "entity_id", "detail"],
    "partial_payment_analysis": ["outstanding_balance DESC", "customer_id", "order_date", "invoice_id"],
    "customer_risk_summary": ["risk_score DESC", "total_outstanding DESC", "customer_id"],
    "recon_dashboard": ["payment_count DESC", "match_type"],
    "high_risk_accounts": ["customer_id"],
}


def _order(report: str) -> list[Column]:
    order = []
    for name in REPORT_ORDER[report]:
        column = F.col(name.removesuffix(" DESC"))
        if report == "aging_report" and name == "aging_sort":
            column = F.array_position(F.lit(DOCUMENT_BUCKETS), F.col("aging_bucket"))
        order.append(column.desc() if name.endswith(" DESC") else column)
    return order


def in_report_order(df: DataFrame, report: str) -> DataFrame:
    """A report in its reading order. A range shuffle, so for exports only."""
    return df.orderBy(*_order(report))


def with_positions(df: DataFrame, report: str, parts: int | None = None) -> DataFrame:
    """A report with each row's ``position`` in the reading order, from 1 without gaps.

    Rows are range-partitioned by the order and numbered inside their range; the rows of the ranges before are
    added, of which there are ``parts`` at most. No task sees the whole report. The ranges are cut by
    sampling, so the partitioned rows are written once (an eager job). Equal rows take any of their places.
    The rows come back range by range, each in its order, so no further sort is needed to write them.
    """
    order = _order(report)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "positions")
    earlier = "ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    before = placed.groupBy("_range").count().selectExpr(
        "_range", f"coalesce(sum(count) OVER ({earlier}), 0) AS _before")
    here = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.repartitionByRange(parts, "_range").withColumn("_row", here).join(
        F.broadcast(before), "_range").select(
        *df.columns, (F.col("_before") + F.col("_row")).cast("long").alias("position"))


def register_views(tables: dict[str, DataFrame]) -> None:
    """(Re)create the three named result views."""
    for key, name in RESULT_VIEWS.items():
        tables[key].createOrReplaceTempView(name)


def export_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV parts with a header each, quoted so that ``read_csv_text`` reads them back unchanged.

    They are plain text unless ``compression`` names a codec (``gzip``), which their readers know by the file ending.
    """
    options = {k: v for k, v in csv_options().items() if k not in ("enforceSchema", "multiLine")}
    df.write.mode("overwrite").options(**options).csv(path, compression=compression)


def export_views(spark: SparkSession, root: str) -> dict[str, str]:
    """The three result views as CSV folders under ``root``."""
    paths = {name: f"{root}/{name}" for name in RESULT_VIEWS.values()}
    for name, path in paths.items():
        view = spark.table(name)
        export_csv(in_report_order(view, "recon_dashboard") if "dashboard" in name else view, path)
    return paths


def write_report(
    report: DataFrame, root: str, run_date: datetime.date | str, name: str = "discrepancy_report",
    numbered: bool = False, compression: str | None = None,
) -> str:
    """A report of one run as CSV, in its reading order; ``numbered`` adds each row's ``position``."""
    folder = "reports" if name == "discrepancy_report" else name
    path = f"{root}/{folder}/run_date={run_date}"
    if numbered:
        report = with_positions(report, name)
    elif name in REPORT_ORDER:
        report = in_report_order(report, name)
    export_csv(report, path, compression)
    return path


def write_snapshot(df: DataFrame, root: str, name: str, run_date: datetime.date | str) -> str:
    """One dated Parquet snapshot; returns the table's root."""
    df.write.mode("overwrite").parquet(f"{root}/{name}/run_date={run_date}")
    return f"{root}/{name}"


def results_rows(
    report: DataFrame,
    run_id: str,
    run_date: datetime.date | str,
    environment: str = "dev",
) -> DataFrame:
    """The discrepancy list in the results table's layout.

    ``result_id`` is a hash of run, kind and content, so a rerun gives the same ids.
    """
    filled = report.selectExpr(
        f"xxhash64('{run_id}', discrepancy_type, entity_id, reference_id, detail, amount) AS result_id",
        f"'{run_id}' AS pipeline_run_id", f"DATE'{run_date}' AS run_date",
        "current_timestamp() AS run_timestamp", "discrepancy_type", "customer_id", "entity_id",
        "reference_id", "amount AS discrepancy_amount", "detail", "classification",
        "coalesce(classification = 'FRAUD', false) AS is_fraud_alert", "false AS is_resolved",
        "NULL AS resolved_at", "NULL AS resolved_by", "NULL AS resolution_notes",
        f"'{environment}' AS environment", "current_timestamp() AS created_at",
    )
    return filled.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in RESULTS.items()])


def write_results(
    rows: DataFrame, root: str, run_date: datetime.date | str, run_id: str
) -> str:
    """One run's discrepancies, by run date, run and kind; the same run again replaces its own."""
    path = f"{root}/ar_reconciliation_results"
    rows.drop("run_date", "pipeline_run_id").write.mode("overwrite").partitionBy("discrepancy_type").parquet(
        f"{path}/run_date={run_date}/pipeline_run_id={run_id}", compression=PACKED)
    return path


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """The discrepancies of all archived runs in the results table's layout."""
    layout = ", ".join(f"{c} {kind}" for c, kind in RESULTS.items())
    return spark.read.schema(layout).parquet(f"{root}/ar_reconciliation_results").select(*RESULTS)


# What makes a finding of one run the same as a finding of another.
FINDING = ["environment", "discrepancy_type", "customer_id", "entity_id", "reference_id", "discrepancy_amount",
           "detail", "classification"]
RESOLUTION = ["resolved_at", "resolved_by", "resolution_notes"]
_RUN = ["run_date", "pipeline_run_id", "discrepancy_type"]


def _same(left: str, right: str, columns: list[str]) -> str:
    return " AND ".join(f"{left}.{c} <=> {right}.{c}" for c in columns)


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the hash of their finding: what is looked up by it is compared in full (``_same_finding``)."""
    return rows.withColumn("_key", F.xxhash64(*FINDING))


def _same_finding(left: str, right: str) -> str:
    """Whether two keyed rows are one finding, as a test that exchanges and sorts rows by their key alone."""
    equal = " + ".join(f"CAST({left}.{c} <=> {right}.{c} AS INT)" for c in FINDING)
    return f"{left}._key = {right}._key AND {equal} = {len(FINDING)}"


# The map of known keys, in bits: for each key, at least (one chunk), and at most (32 MB, sent to all executors).
KEY_BITS, FEWEST_BITS, MOST_BITS = 8, 2**15, 2**28


def _met_or_not(rows: DataFrame, keys: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``_key`` may be one of the ``n`` ``keys``, and those whose key surely is none.

    A bit map of the keys tells them apart, so that only the former need be shuffled. Some of them meet no key, more
    so where the map is full; none of the latter does. Rows without a key belong to the latter.
    """
    bits = min(MOST_BITS, max(FEWEST_BITS, 1 << (KEY_BITS * n).bit_length()))
    place = f"pmod(_key, {bits}L)"
    chunks = keys.groupBy(F.expr(f"{place} div {FEWEST_BITS} AS _chunk")).agg(
        F.expr(f"bitmap_construct_agg({place} % {FEWEST_BITS}) AS _map"))
    byte = f"conv(hex(substring(_map, CAST({place} % {FEWEST_BITS} div 8 AS INT) + 1, 1)), 16, 10)"
    marked = rows.join(F.broadcast(chunks), F.expr(f"{place} div {FEWEST_BITS} = _chunk"), "left").selectExpr(
        *rows.columns, f"coalesce(shiftright(CAST({byte} AS INT), CAST({place} % 8 AS INT)) & 1 = 1, false) AS _met")
    return marked.where("_met").drop("_met"), marked.where("NOT _met").drop("_met")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def merge_run(
    spark: SparkSession, rows: DataFrame, root: str, run_date: datetime.date | str, run_id: str
) -> str:
    """Write one run's discrepancies; those resolved in a run of the same or an earlier date stay resolved.

    A finding is the same if all of ``FINDING`` is equal: another amount or detail is a new finding, open
    again. Equal rows of a run are one finding. The run itself is replaced if it was written before, and
    what was resolved in it is kept. Only rows that may meet a resolved finding are joined, both sides in one
    exchange; ``rows`` are read twice.
    """
    path = f"{root}/ar_reconciliation_results"
    if not _exists(spark, path):
        return write_results(_opened(rows), root, run_date, run_id)
    resolved = _keyed(read_results(spark, root).where(f"is_resolved AND run_date <= DATE'{run_date}'"))
    latest = resolved.repartition("_key").groupBy("_key", *FINDING).agg(
        F.expr(f"max(struct({', '.join(RESOLUTION)})) AS resolution"))
    met, others = _met_or_not(_keyed(rows), resolved, resolved.count())
    kept = [c for c in RESULTS if c not in ("is_resolved", *RESOLUTION)]
    merged = met.alias("r").join(latest.alias("k"), F.expr(_same_finding("r", "k")), "left").selectExpr(
        *[f"r.{c}" for c in kept], "k.resolution IS NOT NULL AS is_resolved",
        *[f"k.resolution.{c} AS {c}" for c in RESOLUTION]).select(*RESULTS).unionByName(_opened(others))
    if _exists(spark, f"{path}/run_date={run_date}/pipeline_run_id={run_id}"):
        # written aside first: the run replaces files it has just read
        merged = written(merged, "merged")
    return write_results(merged, root, run_date, run_id)


def _opened(rows: DataFrame) -> DataFrame:
    """Results of which none is resolved yet."""
    return rows.withColumns({"is_resolved": F.lit(False)} | {
        c: F.lit(None).cast(RESULTS[c]) for c in RESOLUTION}).select(*RESULTS)


def resolve_results(spark: SparkSession, root: str, resolutions: DataFrame) -> str:
    """Resolve findings: ``result_id, resolved_at, resolved_by, resolution_notes``.

    A resolution closes the row it names and the same finding in every run of the same or a later date;
    of several, the newest counts. Only the partitions (run date, run, kind) that hold such a row are written
    again, each replaced as a whole once all of it is written. Resolutions that name no row change nothing.

    Which findings are closed is written aside, by key: first ids and keys are joined, then the driver is told the
    partitions, then the rows that may be of a closed finding are brought together by key.
    """
    path = f"{root}/ar_reconciliation_results"
    results = _keyed(read_results(spark, root))
    answer = ", ".join(f"CAST({c} AS {RESULTS[c]}) AS {c}" for c in RESOLUTION)
    named = results.select("result_id", "run_date", "_key").join(
        resolutions.selectExpr("result_id", f"struct({answer}) AS resolution"), "result_id")
    closed = written(named.groupBy("_key").agg(
        F.expr("min(run_date) AS since"), F.expr("collect_set(struct(result_id, resolution)) AS named")), "resolved")
    met, others = _met_or_not(results, closed, closed.count())
    found = met.select(*_RUN, "_key").join(closed.select("_key", "since"), "_key").where("run_date >= since")
    touched = found.select(*_RUN).distinct().collect()  # a few of the partitions that the driver has listed
    if not touched:
        return path
    runs = F.broadcast(spark.createDataFrame(touched, ", ".join(f"{c} {RESULTS[c]}" for c in _RUN)))

    def within(rows: DataFrame) -> DataFrame:
        return rows.alias("k").join(runs.alias("t"), F.expr(_same("k", "t", _RUN)), "left_semi")

    finding = f"PARTITION BY _key, {', '.join(FINDING)}"
    columns = [c for c in RESULTS if c not in ("is_resolved", *RESOLUTION)]
    settled = (
        within(met).join(closed.select("_key", "named"), "_key", "left")
        .selectExpr("*", "filter(named, x -> x.result_id = result_id) AS _mine")
        .selectExpr(
            "*", f"min(CASE WHEN size(_mine) > 0 THEN run_date END) OVER ({finding}) AS _since",
            f"max(array_max(transform(_mine, x -> x.resolution))) OVER ({finding}) AS _answer")
        .selectExpr(
            *columns, "is_resolved OR coalesce(run_date >= _since, false) AS is_resolved",
            *[f"CASE WHEN run_date >= _since THEN _answer.{c} ELSE {c} END AS {c}" for c in RESOLUTION])
    )
    # the partitions are replaced when all of them are written, so they can be read until then
    settled.select(*RESULTS).unionByName(within(others).select(*RESULTS)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*_RUN).parquet(path, compression=PACKED)
    return path


def summary_row(
    counts: DataFrame, run_id: str, environment: str = "dev",
    success: bool = True, duration: float | None = None, notes: str | None = None,
) -> DataFrame:
    """A one-row count table in the run summary's layout."""
    row = counts.withColumns(
        {
            "pipeline_run_id": F.lit(run_id),
            "run_timestamp": F.current_timestamp(),
            "environment": F.lit(environment),
            "pipeline_success": F.lit(success),
            "total_duration_seconds": F.lit(duration),
            "notes": F.lit(notes),
        }
    )
    return row.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in RUN_SUMMARY.items()])


def write_summary(row: DataFrame, root: str, run_id: str) -> str:
    """Add one run's summary; the same run again replaces its own row."""
    path = f"{root}/ar_pipeline_run_summary"
    row.drop("pipeline_run_id").write.mode("overwrite").parquet(f"{path}/pipeline_run_id={run_id}")
    return path
