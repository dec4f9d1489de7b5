"""Running totals over a customer's invoices, built so that no task sees a whole customer.

An invoice's place in the ledger is (customer, date, invoice_id). Totals are formed on
three levels and added up:

* inside a *chunk*: the rows are range-partitioned by their place in the ledger, and a chunk is
  what one customer and date have in one partition. Ranges are cut where rows are, so sparse, hashed
  or time-based ids split a hot day as well as dense ones do;
* over the chunks of one (customer, date), as many as there are partitions at most;
* over the dates of one customer, of which there are only as many as the calendar has.

The ranges are cut by sampling, so the partitioned rows are written to the shared folder once and
all totals start from the files; otherwise two readings could cut differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitmatch.session import written

DAY = ["customer_id", "invoice_date"]
CHUNK = [*DAY, "chunk"]


def block_of(date: str, width: str) -> str:
    """Number of the ``width``-day block a date falls in."""
    return f"floor(unix_date({date}) / {width})"


def own_and_next_block(date: str, width: str) -> str:
    """Blocks whose payments can look back on this date.

    A look-back window of ``width`` days that ends in block b starts in b or b-1, so an
    invoice is needed by the payments of its own block and of the next, and of no other.
    """
    block = block_of(date, width)
    return f"explode(array({block}, {block} + 1))"


def ranged(rows: DataFrame, place: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` with the ``chunk`` (range partition by ``place``) they fall in, from files."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(parts, *place).withColumn("chunk", F.spark_partition_id().cast("long"))
    return written(cut, "ranged")


def invoice_ledger(invoices: DataFrame, parts: int | None = None) -> DataFrame:
    """The invoices by their place in the ledger, with the chunk they fall in, from files."""
    return ranged(invoices, [*DAY, "invoice_id"], parts)


def running_in_chunks(ledger: DataFrame) -> DataFrame:
    """Each invoice with its row number, running net due and running maximum in its chunk."""
    upto = "PARTITION BY customer_id, invoice_date, chunk ORDER BY invoice_id"
    here = f"{upto} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    before = f"{upto} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return (
        ledger.repartition(*CHUNK)
        .selectExpr(
            "*",
            f"row_number() OVER ({upto}) AS chunk_seq",
            f"CAST(sum(invoice_net_due) OVER ({here}) AS DECIMAL(28,2)) AS chunk_run",
        )
        .selectExpr("*", f"max(chunk_run) OVER ({before}) AS chunk_high_before")
    )


def chunk_totals(rows: DataFrame) -> DataFrame:
    """One row per chunk with what its (customer, date) holds before it."""
    day = "PARTITION BY customer_id, invoice_date"
    earlier = f"{day} ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return (
        rows.groupBy(*CHUNK)
        .agg(
            F.expr("count(*) AS chunk_n"),
            F.expr("CAST(sum(invoice_net_due) AS DECIMAL(28,2)) AS chunk_sum"),
            F.expr("max(chunk_run) AS chunk_top"),
        )
        .selectExpr(
            "*",
            f"coalesce(sum(chunk_n) OVER ({earlier}), 0) AS n_before",
            f"CAST(coalesce(sum(chunk_sum) OVER ({earlier}), 0) AS DECIMAL(28,2)) AS sum_before",
        )
        .selectExpr("*", "CAST(sum_before + chunk_top AS DECIMAL(28,2)) AS top")
        .selectExpr(
            "*", f"max(top) OVER ({earlier}) AS high_before", f"max(top) OVER ({day}) AS day_high"
        )
    )


def day_totals(chunks: DataFrame) -> DataFrame:
    """One row per (customer, date): count, net due and highest running total of the day."""
    return chunks.groupBy(*DAY).agg(
        F.expr("sum(chunk_n) AS day_n"),
        F.expr("CAST(sum(chunk_sum) AS DECIMAL(28,2)) AS day_sum"),
        F.expr("max(top) AS day_high"),
    )


def customer_positions(
    invoices: DataFrame, parts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(invoices with ``position`` and ``running`` over the whole customer, day offsets).

    What a customer has before each chunk is added up once and written (an eager job): the chunks of a customer
    are no more than the dates of the calendar and the partitions of the ledger together.
    """
    ledger = invoice_ledger(invoices, parts)
    earlier = (
        "PARTITION BY customer_id ORDER BY invoice_date, chunk "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )
    offsets = written(
        ledger.groupBy(*CHUNK)
        .agg(
            F.expr("count(*) AS chunk_n"),
            F.expr("CAST(sum(invoice_net_due) AS DECIMAL(28,2)) AS chunk_sum"),
        )
        .selectExpr(
            *CHUNK,
            f"coalesce(sum(chunk_n) OVER ({earlier}), 0) AS n_offset",
            f"CAST(coalesce(sum(chunk_sum) OVER ({earlier}), 0) AS DECIMAL(28,2)) AS sum_offset",
            "row_number() OVER (PARTITION BY customer_id, invoice_date ORDER BY chunk) = 1 AS opens_day",
        ),
        "offsets",
    )
    days = offsets.where("opens_day").selectExpr(*DAY, "n_offset AS n_start", "sum_offset AS sum_start")
    placed = running_in_chunks(ledger).join(offsets, CHUNK).selectExpr(
        *DAY, "invoice_id", "invoice_net_due",
        "n_offset + chunk_seq AS position",
        "CAST(sum_offset + chunk_run AS DECIMAL(28,2)) AS running",
    )
    return placed, days
