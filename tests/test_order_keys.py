"""Documents built from line items: one shuffle of the lines, joined by order key."""

import datetime
from decimal import Decimal

import pytest

from remitmatch.harness import testdata as data

DAY = datetime.datetime(1995, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("orders")
    spark.createDataFrame(
        [(1, 7, "O", 100.0, DAY), (1, 7, "F", 100.0, DAY), (2, 8, "O", 50.0, DAY), (None, 9, "O", 5.0, DAY)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
    ).write.parquet(f"{root}/orders.parquet")
    line = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, " \
           "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(
        [(1, 1, 4, 3, 1.0, 10.0, "R", "F", DAY), (1, 1, 5, 4, 2.0, 9.0, "R", "F", DAY),
         (1, 2, 6, 3, 1.0, 7.0, "A", "F", DAY), (None, 1, 6, 3, 1.0, 7.0, "R", "F", DAY)], line,
    ).write.parquet(f"{root}/lineitem.parquet")
    return str(root)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line for line in plan.splitlines())


@pytest.mark.parametrize("build", [data.invoice_documents, data.return_documents, data.ar_payments])
def test_orders_and_lines_are_shuffled_by_order_only(spark, tables, build):
    whole = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        most = 3 if build is data.return_documents else 2
        assert exchanges(build(spark, tables)) <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", whole)


def test_repeated_and_missing_order_keys(spark, tables):
    documents = data.invoice_documents(spark, tables).collect()
    assert sorted((r.invoice_id or "", len(r.line_items or [])) for r in documents) == [
        ("", 0), ("INV-1000001", 2), ("INV-1000001", 2), ("INV-1000002", 0)]
    (first, _) = next(r.line_items for r in documents if r.line_items)
    assert (first.sku, first.quantity, first.unit_price) == ("SKU-000004", 3, Decimal("0.0090"))
    assert data.return_documents(spark, tables).count() == 2
