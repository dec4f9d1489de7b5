"""Idempotent intake of daily drops: a date whose files were rewritten is replaced.

The file stream of ``daily_drop`` knows files by name and takes each in once, so a corrected file that is
sent again under its name is never read. Here every run compares the drops with a log of the files taken
in: path, length, time of change and a digest of the lines. Only files that look new are read for their
digest, and only dates whose lines as a whole have changed are read and written again (part files may have
other names). The rows of such a
date replace the ones landed before, whole; other dates are not touched.

The order of steps makes a run repeatable: data first, then the log. A run that was lost in between
leaves an old log, and the next one replaces the same dates by the same rows.

The log is a Parquet table with a row per file and intake, the newest intake of a date counting. A date that
no longer has any file keeps its landed rows. Files in a folder whose name is no date share the
``run_date`` NULL and are replaced together. Two runs at one time on one target are not supported.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitmatch.schemas import DOCUMENT_CSV
from remitmatch.session import written
from remitmatch.sources.documents import csv_options
from remitmatch.sources.drops import RUN_DATE

LOG = ("intake bigint, run_date date, path string, length bigint, changed timestamp, lines bigint, "
       "digest decimal(38,0)")
_DATE_OF_PATH = RUN_DATE.replace("_metadata.file_path", "path")


def listed(spark: SparkSession, root: str, entity: str, prefix: str | None = None) -> DataFrame:
    """``path, length, changed, run_date`` of every file of one entity; no content is read."""
    pattern = f"{root}/{(prefix or entity).strip('/')}/*/{entity}.csv"
    return spark.read.format("binaryFile").load(pattern).selectExpr(
        "path", "length", "modificationTime AS changed", f"{_DATE_OF_PATH} AS run_date")


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, lines, digest`` of the files' lines; their order within a file is part of no digest.

    A sum over two hashes of each line, so large files are summed by many tasks.
    """
    return (
        spark.read.text(paths)
        .selectExpr("_metadata.file_path AS path", "xxhash64(value) AS h", "xxhash64(value, 1) AS g")
        .groupBy("path")
        .agg(F.expr("count(*) AS lines"),
             F.expr("CAST(sum(CAST(h AS DECIMAL(38,0)) + 3 * CAST(g AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS digest"))
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log, empty where none was written yet."""
    try:
        return spark.read.schema(LOG).parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def _known(log: DataFrame) -> DataFrame:
    """The files of each date as its newest intake found them."""
    newest = Window.partitionBy("run_date")
    return log.withColumn("newest", F.max("intake").over(newest)).where("intake = newest").drop("newest")


def take_in(
    spark: SparkSession, root: str, entity: str, target: str, log: str, prefix: str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Bring ``target`` up to the drops; returns ``run_date, action, files, lines`` of the dates looked at.

    ``action`` is ``new``, ``replaced`` or ``same`` (files with another time but the same lines).
    """
    history = read_log(spark, log)
    known = _known(history)
    found = listed(spark, root, entity, prefix)
    same_file = [found.path == known.path, found.length == known.length, found.changed == known.changed]
    fresh = found.join(known, same_file, "left_anti").select("run_date")
    gone = known.join(found, found.path == known.path, "left_anti").select("run_date")
    still = found.select("run_date").distinct()
    dates = fresh.union(gone).distinct().alias("d").join(
        still.alias("s"), F.expr("d.run_date <=> s.run_date"), "left_semi")
    files = written(
        found.alias("f").join(F.broadcast(dates).alias("d"), F.expr("f.run_date <=> d.run_date"), "left_semi"), "files")
    paths = [r["path"] for r in files.select("path").collect()]  # the changed dates' files, not all
    if not paths:
        return spark.createDataFrame([], "run_date date, action string, files bigint, lines bigint")
    number = (history.agg(F.max("intake")).first()[0] or 0) + 1
    seen = written(
        files.join(digests(spark, paths), "path", "left").selectExpr(
            f"CAST({number} AS BIGINT) AS intake", "run_date", "path", "length", "changed",
            "coalesce(lines, 0L) AS lines", "coalesce(digest, CAST(0 AS DECIMAL(38,0))) AS digest"), "seen")

    def content(rows: DataFrame) -> DataFrame:
        return rows.groupBy("run_date").agg(
            F.expr("count(*) AS files"), F.expr("sum(lines) AS lines"),
            F.expr("struct(sum(lines), CAST(sum(digest) AS DECIMAL(38,0))) AS content"))

    now, before = content(seen).alias("now"), content(known).alias("before")
    outcome = written(
        now.join(before, F.expr("now.run_date <=> before.run_date"), "left").selectExpr(
            "now.run_date",
            """CASE WHEN before.content IS NULL THEN 'new'
                    WHEN now.content <> before.content THEN 'replaced' ELSE 'same' END AS action""",
            "now.files", "now.lines"), "outcome")
    changed = outcome.where("action <> 'same'")
    _replace(spark, entity, target, seen, changed, multiline)
    seen.write.mode("append").parquet(log)
    return outcome


def _replace(spark: SparkSession, entity: str, target: str, seen: DataFrame, changed: DataFrame,
             multiline: bool) -> None:
    """Write the rows of the changed dates over what was landed for them."""
    files = seen.alias("f").join(F.broadcast(changed).alias("c"), F.expr("f.run_date <=> c.run_date"), "left_semi")
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return
    rows = (
        spark.read.schema(DOCUMENT_CSV[entity]).options(**csv_options(multiline)).csv(paths)
        .selectExpr("*", f"{RUN_DATE} AS run_date")
    )
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(target)
    # a date without rows writes no partition of its own, so what it had landed is emptied by name
    landed = spark.read.schema(rows.schema).parquet(target).select("run_date").distinct()
    given = rows.select("run_date").distinct()
    emptied = changed.select("run_date").alias("c").join(
        given.alias("g"), F.expr("c.run_date <=> g.run_date"), "left_anti").join(
        landed.alias("l"), F.expr("c.run_date <=> l.run_date"), "left_semi")
    for row in emptied.collect():  # dates, at most as many as the calendar has
        folder = "__HIVE_DEFAULT_PARTITION__" if row["run_date"] is None else row["run_date"]
        rows.limit(0).drop("run_date").write.mode("overwrite").parquet(f"{target}/run_date={folder}")
