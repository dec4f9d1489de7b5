"""Where rules are worked out: in a compiled projection, once per row."""

from remitmatch.functions.plan import kept_where, once
from remitmatch.operators import validation
from remitmatch.sources import documents

PAYMENT = ("PMT-1", "INV-100001", "CUST-1001", "2024-13-01", "-5.00", "BARTER", None, "CLEARED", None)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def generators(df):
    return [line for line in plan(df).splitlines() if "Generate" in line]


def test_no_rule_stands_in_a_generator(spark):
    layout = documents.DOCUMENT_CSV["payments"]
    raw = spark.createDataFrame([PAYMENT], layout)
    checked = documents.read_documents(raw, "payments")
    errors = validation.schema_violations(documents.arrange(raw, "payments"), "payments")
    for df in (checked, errors):
        assert generators(df) and not any("RLIKE" in g for g in generators(df)), plan(df)
    assert [v.rule for v in checked.first().violations] == [
        "payment_id", "payment_date", "amount_paid", "payment_method"]
    assert errors.first().asDict() == {
        "entity": "payments", "entity_id": "PMT-1", "first_path": "amount_paid", "first_rule": "minimum",
        "total_errors": 3}


def test_kept_values_stay_in_order_and_a_test_without_answer_keeps_nothing(spark):
    df = spark.createDataFrame([(5,), (None,)], "x int")
    kept = kept_where([("x > 3", "'big'"), ("x IS NULL", "'none'"), ("x > 4", "'bigger'"), ("x < 0", "'low'")], "string")
    rows = {r.x: list(r.found) for r in once(df, ["x"], kept, "found").collect()}
    assert rows == {5: ["big", "bigger"], None: ["none"]}
