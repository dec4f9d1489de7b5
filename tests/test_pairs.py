"""Payment-invoice pairs and the closest invoice in crowded blocks, against brute force."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from remitmatch.operators import pairs
from remitmatch.settings import Setting

SETTING = Setting("active", 10, Decimal("50.00"))
NET = ("invoice_id long, customer_id long, invoice_date date, due_date date, invoice_amount decimal(18,2), "
       "credits_applied decimal(18,2), returns_credit decimal(18,2), invoice_net_due decimal(18,2)")
PAYMENTS = "payment_id long, customer_id long, payment_amount decimal(18,2), payment_date date"


def rows(seed, odd=True):
    """Half of all rows on one customer; with ``odd``, some keys and amounts missing, some payments twice."""
    rng = random.Random(seed)

    def maybe(value):
        return None if odd and rng.random() < 0.03 else value

    def money():
        return Decimal(rng.choice([10, 20, rng.randint(-50, 300)])).quantize(Decimal("0.01"))

    def owner():
        return rng.choice([7, rng.randint(100, 110)])

    def date():
        return datetime.date(1969, 12, 20) + datetime.timedelta(days=rng.choice([8, rng.randint(0, 40)]))

    invoices = []
    for i in range(300):
        net = maybe(money())
        invoices.append((maybe(i), maybe(owner()), maybe(date()), None, net, Decimal(0), Decimal(0), net))
    payments = [(maybe(i), maybe(owner()), maybe(money()), maybe(date())) for i in range(200)]
    return invoices, payments + (payments[::17] if odd else [])


def expected(invoices, payments):
    return [
        (p, i) for p in payments for i in invoices
        if None not in (p[1], p[3], i[1], i[2]) and p[1] == i[1]
        and p[3] - datetime.timedelta(days=SETTING.days_window) <= i[2] <= p[3]
    ]


def order(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("tile", [3, 256])
def test_eligible_invoices(spark, seed, tile):
    invoices, payments = rows(seed)
    got = pairs.eligible_invoices(
        spark.createDataFrame(payments, PAYMENTS), spark.createDataFrame(invoices, NET), SETTING, tile=tile)
    want = [(p[0], p[1], p[2], p[3], i[0], *i[2:]) for p, i in expected(invoices, payments)]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("tile", [3, 256])
def test_greedy_running(spark, tile):
    invoices, payments = rows(3, odd=False)
    got = pairs.greedy_running(
        spark.createDataFrame(payments, PAYMENTS), spark.createDataFrame(invoices, NET), SETTING, tile=tile)
    want, state = [], {}
    for p, i in sorted(expected(invoices, payments), key=lambda pair: (pair[0][0], pair[1][2], pair[1][0])):
        seq, running = state.get(p[0], (0, Decimal(0)))
        state[p[0]] = seq + 1, running + i[7]
        want.append((p[0], p[1], p[2], p[3], i[0], i[2], i[7], *state[p[0]]))
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("inline_limit", [0, 5, 256])
def test_single_best(spark, seed, inline_limit):
    invoices, payments = rows(seed)
    got = pairs.single_best(
        spark.createDataFrame(payments, PAYMENTS), spark.createDataFrame(invoices, NET), SETTING,
        inline_limit=inline_limit)
    best = {}
    for p, i in expected(invoices, payments):
        off = None if p[2] is None or i[7] is None else abs(p[2] - i[7])
        best.setdefault(p[0], []).append((off, i[0], i[7]))
    want = [(k, *min(v, key=order)) for k, v in best.items()]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


def test_crowded_pairs_come_from_many_join_keys(spark):
    """One customer and date: 400 payments by 300 invoices are not one key's work, and no pair is reduced."""
    day = datetime.date(2024, 1, 1)
    net = spark.range(300).selectExpr("id AS invoice_id", "7L AS customer_id", f"DATE'{day}' AS invoice_date",
                                      "CAST(id AS DECIMAL(18,2)) AS invoice_net_due")
    paid = spark.range(400).selectExpr("id AS payment_id", "7L AS customer_id",
                                       "CAST(id AS DECIMAL(18,2)) AS payment_amount", f"DATE'{day}' AS payment_date")
    tiled = pairs._pairs(paid, net, SETTING, tile=32).groupBy("asked_tile", "offered_tile").agg(F.count("*").alias("n"))
    sizes = [r.n for r in tiled.collect()]
    assert sum(sizes) == 400 * 300
    assert len(sizes) == 13 * 2 and max(sizes) < 4 * 32 * 256
    best = pairs.single_best(paid, net, SETTING)
    assert {(r.payment_id, r.abs_diff) for r in best.collect()} == {(i, max(0, i - 299)) for i in range(400)}


def double(value):
    return float(value) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("tile", [3, 1024])
def test_pairs_in_doubles(spark, tile):
    """Amounts converted before rows are paired are those of the decimals, also past what whole cents hold exactly."""
    invoices, payments = rows(4)
    invoices = [(*i[:4], *(v and v * 10**12 if i[1] == 105 else v for v in i[4:])) for i in invoices]
    paid, net = spark.createDataFrame(payments, PAYMENTS), spark.createDataFrame(invoices, NET)
    for pair in (pairs.eligible_invoices, pairs.greedy_running):
        exact, got = pair(paid, net, SETTING, tile=tile), pair(paid, net, SETTING, tile=tile, doubles=True)
        assert "decimal" not in got.schema.simpleString() and got.columns == exact.columns
        want = sorted((tuple(map(double, r)) for r in exact.collect()), key=order)
        assert sorted(map(tuple, got.collect()), key=order) == want and len(want) > 1000


def test_no_amount_is_converted_pair_by_pair(spark):
    """Above the join of the pairs stands no conversion from a decimal, in the registered queries."""
    from remitmatch.harness import registry

    for name in ("eligible_invoices", "greedy_running"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        above = plan.split("Join", 1)[0]
        for amount in ("payment_amount", "invoice_amount", "credits_applied", "invoice_net_due"):
            assert f"cast({amount}" not in above, plan


def test_positions_in_a_customers_ledger(spark):
    """Positions and offsets over dates that several ranges share, against a plain walk through the ledger."""
    from remitmatch.operators.ledger import customer_positions

    invoices = [i for i in rows(5)[0] if None not in i[:3]]
    net = spark.createDataFrame(invoices, NET).select("customer_id", "invoice_date", "invoice_id", "invoice_net_due")
    placed, days = customer_positions(net, parts=7)
    want, starts, at = [], {}, {}
    for i in sorted(invoices, key=lambda i: (i[1], i[2], i[0])):
        n, total = at.get(i[1], (0, Decimal(0)))
        starts.setdefault((i[1], i[2]), (n, total))
        at[i[1]] = n + 1, total + (i[7] or 0)
        want.append((i[1], i[2], i[0], i[7], at[i[1]][0]))
    got = placed.collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert {(r[0], r[1]): (r[2], r[3]) for r in days.collect()} == starts and days.count() == len(starts)
