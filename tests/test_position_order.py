"""Numbered reports come back range by range, so writing them needs no second sort."""

from remitmatch.sinks.outputs import with_positions


def test_positions_rise_as_rows_come(spark):
    names = [f"m{i * 7919 % 1000:04}" for i in range(1000)]
    report = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "customer_id string, n int").repartition(5)
    # without adaptive execution, which would put so few rows into one task
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = with_positions(report, "high_risk_accounts", parts=7).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.position for r in rows] == list(range(1, 1001))
    assert [r.customer_id for r in rows] == sorted(names)
