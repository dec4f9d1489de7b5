"""Incremental intake of daily drops: every file is taken in exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from remitmatch.schemas import DOCUMENT_CSV
from remitmatch.sources.documents import csv_options
from remitmatch.sources.drops import RUN_DATE


def drop_stream(
    spark: SparkSession, root: str, entity: str, prefix: str | None = None
) -> DataFrame:
    """A file stream over all drops of one entity.

    A folder whose name is no date sets its rows aside: they get the ``run_date`` NULL, that is
    the partition of rows without a date, and the stream goes on.
    """
    return (
        spark.readStream.schema(DOCUMENT_CSV[entity])
        .options(**csv_options())
        .csv(f"{root}/{(prefix or entity).strip('/')}/*/{entity}.csv")
        .selectExpr("*", f"{RUN_DATE} AS run_date")
    )


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append whatever is new to a Parquet table by run date, then stop.

    The checkpoint remembers the files taken in, so a rerun, or a run after a failure,
    neither skips nor repeats a drop.
    """
    return (
        stream.writeStream.format("parquet")
        .partitionBy("run_date")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
