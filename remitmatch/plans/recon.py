"""Flat-track queries: reconciliation results, review list, dashboard, scenarios, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.operators.matching import match_payments
from remitmatch.schemas import MONEY, TOTAL
from remitmatch.settings import Settings

NEEDS_REVIEW = ["NO_CUTOFF_IN_WINDOW", "NO_INVOICES_IN_WINDOW"]

RESULT_COLUMNS = [
    "payment_id", "customer_id", "payment_date", "payment_amount", "match_type",
    "eligible_invoice_count", "sum_net_due_in_window", "gap_amount", "matched_invoice_id",
    "matched_invoice_net_due", "single_match_abs_diff", "cutoff_invoice_id",
    "cutoff_invoice_date", "greedy_running_net_due_at_cutoff",
]


def classify(matched: DataFrame) -> DataFrame:
    """Name each payment's outcome and lay out the report columns."""
    match_type = (
        F.when(F.coalesce("eligible_invoice_count", F.lit(0)) == 0, "NO_INVOICES_IN_WINDOW")
        .when(F.col("single").isNotNull(), "SINGLE_MATCH")
        .when(F.col("cutoff").isNotNull(), "MULTI_OR_PARTIAL_GREEDY")
        .otherwise("NO_CUTOFF_IN_WINDOW")
    )
    return matched.select(
        "scenario", "payment_id", "customer_id", "payment_date", "payment_amount",
        match_type.alias("match_type"),
        "eligible_invoice_count",
        F.col("sum_net_due").alias("sum_net_due_in_window"),
        (F.col("payment_amount") - F.col("sum_net_due")).cast(TOTAL).alias("gap_amount"),
        F.col("single.invoice_id").alias("matched_invoice_id"),
        F.col("single.net").cast(MONEY).alias("matched_invoice_net_due"),
        F.col("single.abs_diff").cast(MONEY).alias("single_match_abs_diff"),
        F.col("cutoff.invoice_id").alias("cutoff_invoice_id"),
        F.col("cutoff.day").alias("cutoff_invoice_date"),
        F.col("cutoff.running").alias("greedy_running_net_due_at_cutoff"),
    )


def recon_scenarios(tables: dict[str, DataFrame], settings: Settings, **tuning) -> DataFrame:
    """Results under every given setting, from one pass over the tables."""
    return classify(
        match_payments(
            tables["payments"], tables["invoices"], tables["credits"], tables["returns"],
            settings, **tuning,
        )
    )


def recon_results(tables: dict[str, DataFrame], settings: Settings, **tuning) -> DataFrame:
    """One row per payment under the active setting (``settings`` holds at most one).

    With a table of settings (``settings.active_relation``) the stored row drives the plan when it runs.
    """
    return recon_scenarios(tables, settings, **tuning).select(*RESULT_COLUMNS)


def needs_review(results: DataFrame) -> DataFrame:
    """Payments nobody could explain from the window."""
    return results.where(F.col("match_type").isin(NEEDS_REVIEW))


def dashboard(results: DataFrame, *keys: str) -> DataFrame:
    """Payments and money per outcome, optionally per further key (scenario, run date)."""
    return results.groupBy(*keys, "match_type").agg(
        F.count("*").alias("payment_count"),
        F.sum("payment_amount").cast(TOTAL).alias("total_payment_amount"),
    )


def recon_sanity(payments: DataFrame, results: DataFrame) -> DataFrame:
    """One row of checks on a finished reconciliation."""
    totals = results.agg(
        F.count("*").alias("results"),
        F.count_if(F.col("match_type").isin(NEEDS_REVIEW)).alias("needs_review"),
        *[
            F.count_if(F.col("match_type") == kind).alias(kind.lower())
            for kind in ("SINGLE_MATCH", "MULTI_OR_PARTIAL_GREEDY", *NEEDS_REVIEW)
        ],
    )
    paid = payments.agg(F.count("*")).scalar()
    return totals.select(
        paid.alias("payments"),
        "results", "needs_review", "single_match", "multi_or_partial_greedy",
        "no_cutoff_in_window", "no_invoices_in_window",
        F.lit("gap_amount" in results.columns).alias("has_gap_amount"),
        (paid > 0).alias("payments_present"),
        (F.col("results") == paid).alias("one_row_per_payment"),
        (F.col("needs_review") <= F.col("results")).alias("review_is_subset"),
    )
