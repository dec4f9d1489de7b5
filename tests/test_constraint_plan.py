"""Keys of constraints are sorted and joined by a number first."""

from remitmatch.operators import constraints
from remitmatch.operators.constraints import Rules

RULES = {
    "parents": Rules(key=("a", "b")),
    "children": Rules(not_null=("c",), references=(("fk", ("a", "b"), "parents"),), row_key=("c",)),
}


def test_references_are_joined_by_a_number_before_names_and_keys(spark):
    parents = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "a int, b string")
    children = spark.createDataFrame(
        [(1, "x", "c1"), (2, "x", "c2"), (3, "y", None), (4, None, "c4"), (2, "x", "c2")], "a int, b string, c string")
    found = constraints.violations({"parents": parents, "children": children}, RULES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "Join " in line]
    assert "(place#" in join, join
    assert sorted(map(tuple, found.collect())) == [
        ("children", "fk", "c2"), ("children", "fk", "c2"), ("children", "nn_children_c", ""),
        ("parents", "nn_parents_b", "2"), ("parents", "pk_parents", "1|x")]
