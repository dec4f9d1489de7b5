"""Accounts-receivable reconciliation on Spark DataFrames."""
