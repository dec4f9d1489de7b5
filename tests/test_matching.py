"""The payment matcher: the edge fixture, and a skewed random set against brute force."""

import datetime
import random
from decimal import Decimal

import duckdb
import pytest

from remitmatch.operators import matching
from remitmatch.operators.ledger import DAY, chunk_totals, invoice_ledger, running_in_chunks
from remitmatch.operators.matching import _deep_rows, _tree, has_deep_days
from remitmatch.operators.netting import invoice_net_due
from remitmatch.plans.recon import dashboard, needs_review, recon_results, recon_scenarios
from remitmatch.settings import DEFAULT, PRESETS, Setting, active_relation

INVOICES = "invoice_id long, customer_id long, invoice_date date, due_date date, invoice_amount decimal(18,2)"
PAYMENTS = "payment_id long, customer_id long, payment_amount decimal(18,2), payment_date date, reference_notes string"
CREDITS = "credit_id long, customer_id long, credit_amount decimal(18,2), applied_invoice_id long"
RETURNS = "return_id long, customer_id long, original_invoice_id long, return_sku string, credit_amount decimal(18,2)"

# Every look-up path: everything inline; every date deep; many chunks and bands per date.
TUNINGS = [
    {"deep_days": False},
    {"inline_limit": 0},
    {"inline_limit": 1, "parts": 7, "band_rows": 3},
    {"inline_limit": 3, "parts": 40, "band_rows": 1},
]


def day(text):
    return datetime.date.fromisoformat(text)


def money(value):
    return Decimal(value).quantize(Decimal("0.01"))


def tables(spark, invoices, payments, credits=(), returns=()):
    return {
        "invoices": spark.createDataFrame(list(invoices), INVOICES),
        "payments": spark.createDataFrame(list(payments), PAYMENTS),
        "credits": spark.createDataFrame(list(credits), CREDITS),
        "returns": spark.createDataFrame(list(returns), RETURNS),
    }


@pytest.fixture(scope="module")
def edge(spark):
    invoices = [
        (1, 1, "2024-01-01", 100), (2, 1, "2024-01-15", 200), (10, 2, "2024-02-01", 500),
        (11, 2, "2024-02-02", 100), (20, 3, "2024-02-01", 100), (21, 3, "2024-02-03", 100),
    ]
    payments = [
        (1, 1, 100, "2024-03-01"), (2, 1, 250, "2024-03-02"), (3, 1, 280, "2024-03-01"),
        (4, 1, 400, "2024-03-01"), (5, 9, 10, "2024-03-01"), (6, 2, 400, "2024-02-10"),
        (7, 3, 100, "2024-02-10"),
    ]
    return tables(
        spark,
        [(i, c, day(d), None, money(a)) for i, c, d, a in invoices],
        [(i, c, money(a), day(d), None) for i, c, a, d in payments],
        [(1, 2, money(400), 11), (2, 2, money(75), None)],
    )


@pytest.mark.parametrize("tuning", TUNINGS)
def test_edge_fixture(edge, tuning):
    rows = {r.payment_id: r for r in recon_results(edge, [DEFAULT], **tuning).collect()}
    expected = {
        # type, count, sum, gap, matched, cutoff, running
        1: ("SINGLE_MATCH", 2, 300, -200, 1, 1, 100),
        2: ("SINGLE_MATCH", 1, 200, 50, 2, None, None),
        3: ("MULTI_OR_PARTIAL_GREEDY", 2, 300, -20, None, 2, 300),
        4: ("NO_CUTOFF_IN_WINDOW", 2, 300, 100, None, None, None),
        5: ("NO_INVOICES_IN_WINDOW", None, None, None, None, None, None),
        6: ("MULTI_OR_PARTIAL_GREEDY", 2, 200, 200, None, 10, 500),
        7: ("SINGLE_MATCH", 2, 200, -100, 20, 20, 100),
    }
    got = {
        key: (
            r.match_type, r.eligible_invoice_count, r.sum_net_due_in_window, r.gap_amount,
            r.matched_invoice_id, r.cutoff_invoice_id, r.greedy_running_net_due_at_cutoff,
        )
        for key, r in rows.items()
    }
    assert got == expected
    assert rows[6].cutoff_invoice_date == day("2024-02-01")


def test_no_setting_means_no_invoices(edge):
    rows = recon_results(edge, []).collect()
    assert len(rows) == 7
    assert {r.match_type for r in rows} == {"NO_INVOICES_IN_WINDOW"}


def test_review_and_dashboard(edge):
    results = recon_results(edge, [DEFAULT])
    assert {r.payment_id for r in needs_review(results).collect()} == {4, 5}
    counts = {r.match_type: (r.payment_count, r.total_payment_amount) for r in dashboard(results).collect()}
    assert counts["SINGLE_MATCH"] == (3, Decimal("450.00"))


def skewed(seed):
    """A third of all rows on one customer, a third of those on one date; many equal amounts."""
    rng = random.Random(seed)
    start = day("2024-01-01")

    def customer():
        return 7 if rng.random() < 0.35 else rng.randint(100, 140)

    def date(owner, spread):
        crowded = owner == 7 and rng.random() < 0.35
        return start + datetime.timedelta(days=40 if crowded else rng.randint(0, spread))

    def amount():
        return money(rng.choice([10, 20, 20.5, 99.99, rng.randint(-50, 900), rng.uniform(0, 300)]))

    invoices = []
    for i in range(700):
        owner = customer()
        invoices.append((i * 3 + 1, owner, date(owner, 150), None, amount()))
    payments = []
    for i in range(500):
        owner = customer()
        size = amount() * rng.choice([1, 1, 1, 3, 10, 100])
        payments.append((i, owner, money(size), date(owner, 200), None))
    credits = [
        (i, 0, money(rng.randint(1, 60)), rng.choice([None, rng.choice(invoices)[0]])) for i in range(150)
    ]
    returns = [(i, 0, rng.randint(1, 2600), "SKU_1", money(rng.randint(1, 40))) for i in range(120)]
    return invoices, payments, credits, returns


BRUTE_FORCE = """
WITH net AS (
  SELECT invoice_id, customer_id, invoice_date, invoice_amount
         - coalesce((SELECT sum(credit_amount) FROM credits c WHERE c.applied_invoice_id = i.invoice_id), 0)
         - coalesce((SELECT sum(credit_amount) FROM returns r WHERE r.original_invoice_id = i.invoice_id), 0) AS net
  FROM invoices i
),
pairs AS (
  SELECT s.scenario, s.tolerance, p.payment_id, p.payment_amount, n.*,
         row_number() OVER (PARTITION BY scenario, payment_id ORDER BY abs(payment_amount - net), invoice_id) AS rn,
         sum(net) OVER (PARTITION BY scenario, payment_id ORDER BY invoice_date, invoice_id
                        ROWS UNBOUNDED PRECEDING) AS running,
         row_number() OVER (PARTITION BY scenario, payment_id ORDER BY invoice_date, invoice_id) AS seq
  FROM payments p CROSS JOIN settings s JOIN net n ON n.customer_id = p.customer_id
       AND n.invoice_date BETWEEN p.payment_date - s.days_window AND p.payment_date
),
counts AS (SELECT scenario, payment_id, count(*) AS n, sum(net) AS total FROM pairs GROUP BY ALL),
single AS (SELECT * FROM pairs WHERE rn = 1 AND abs(payment_amount - net) <= tolerance),
cutoff AS (SELECT * FROM pairs WHERE running >= payment_amount
           QUALIFY row_number() OVER (PARTITION BY scenario, payment_id ORDER BY seq) = 1)
SELECT s.scenario, p.payment_id, c.n, c.total, m.invoice_id, m.net, k.invoice_id, k.invoice_date, k.running
FROM payments p CROSS JOIN settings s
LEFT JOIN counts c ON c.scenario = s.scenario AND c.payment_id = p.payment_id
LEFT JOIN single m ON m.scenario = s.scenario AND m.payment_id = p.payment_id
LEFT JOIN cutoff k ON k.scenario = s.scenario AND k.payment_id = p.payment_id
"""


def brute_force(data, settings):
    con = duckdb.connect()
    con.execute("CREATE TABLE invoices (invoice_id BIGINT, customer_id BIGINT, invoice_date DATE, due_date DATE, invoice_amount DECIMAL(18,2))")
    con.execute("CREATE TABLE payments (payment_id BIGINT, customer_id BIGINT, payment_amount DECIMAL(18,2), payment_date DATE, notes VARCHAR)")
    con.execute("CREATE TABLE credits (credit_id BIGINT, customer_id BIGINT, credit_amount DECIMAL(18,2), applied_invoice_id BIGINT)")
    con.execute("CREATE TABLE returns (return_id BIGINT, customer_id BIGINT, original_invoice_id BIGINT, sku VARCHAR, credit_amount DECIMAL(18,2))")
    con.execute("CREATE TABLE settings (scenario VARCHAR, days_window INTEGER, tolerance DECIMAL(18,2))")
    for name, rows in zip(("invoices", "payments", "credits", "returns"), data):
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    con.executemany("INSERT INTO settings VALUES (?, ?, ?)", [tuple(s) for s in settings])
    return sorted(con.execute(BRUTE_FORCE).fetchall(), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("tuning", TUNINGS)
@pytest.mark.parametrize(
    "settings",
    [PRESETS, [Setting("zero", 0, Decimal("0.00")), Setting("week", 6, Decimal("0.50"))]],
    ids=["presets", "narrow"],
)
def test_skewed_against_brute_force(spark, tuning, settings):
    data = skewed(5)
    results = recon_scenarios(tables(spark, *data), settings, **tuning)
    got = sorted(
        (
            (
                r.scenario, r.payment_id, r.eligible_invoice_count, r.sum_net_due_in_window,
                r.matched_invoice_id, r.matched_invoice_net_due, r.cutoff_invoice_id,
                r.cutoff_invoice_date, r.greedy_running_net_due_at_cutoff,
            )
            for r in results.collect()
        ),
        key=lambda r: (r[0], r[1]),
    )
    assert got == brute_force(data, settings)


def test_crowded_dates_are_noticed(spark):
    invoices = tables(spark, *skewed(5))["invoices"]
    assert has_deep_days(invoices)
    assert not has_deep_days(invoices, inline_limit=1000)


def test_one_huge_invoice_on_a_crowded_date(spark):
    """Nodes of the look-up are cut by rows, so an invoice above all others fills none of them."""
    rng = random.Random(2)
    date = day("2024-02-01")
    invoices = [(i, 7, date, None, money(10_000_000 if i == 57 else rng.randint(1, 40))) for i in range(500)]
    payments = [(i, 7, money(rng.randint(1, 10_005_000)), day("2024-02-10"), None) for i in range(300)]
    payments += [(1000 + i, 7, money(rng.randint(1, 3000)), date, None) for i in range(100)]
    data = (invoices, payments, [(1, 7, money(5), 3)], [(1, 7, 4, "SKU_1", money(60))])
    results = recon_scenarios(tables(spark, *data), [DEFAULT], band_rows=8, parts=5)
    got = sorted(
        (r.scenario, r.payment_id, r.eligible_invoice_count, r.sum_net_due_in_window, r.matched_invoice_id,
         r.matched_invoice_net_due, r.cutoff_invoice_id, r.cutoff_invoice_date, r.greedy_running_net_due_at_cutoff)
        for r in results.collect())
    assert got == brute_force(data, [DEFAULT])
    assert sum(r[6] == 57 for r in got) > 200
    net = invoice_net_due(*[tables(spark, *data)[t] for t in ("invoices", "credits", "returns")])
    rows = running_in_chunks(invoice_ledger(net.select(*DAY, "invoice_id", "invoice_net_due"), 5))
    root, *levels = _tree(_deep_rows(rows, chunk_totals(rows)), 8)
    assert root.selectExpr("max(size(root))").first()[0] <= 500 // 64 + 1
    assert all(nodes.selectExpr("max(size(children))").first()[0] <= 8 for nodes in levels)


STORED = "id int, days_window int, tolerance_amount decimal(18,2)"


def test_the_stored_row_drives_the_plan(spark, edge):
    stored = spark.createDataFrame([(1, 60, money(50)), (2, 500, money(9))], STORED)
    got = recon_results(edge, active_relation(stored))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, recon_results(edge, [DEFAULT]).collect()))
    data = skewed(5)
    results = recon_scenarios(
        tables(spark, *data), active_relation(spark.createDataFrame([(1, 90, money("0.50"))], STORED)), inline_limit=2)
    got = sorted(
        (r.scenario, r.payment_id, r.eligible_invoice_count, r.sum_net_due_in_window, r.matched_invoice_id,
         r.matched_invoice_net_due, r.cutoff_invoice_id, r.cutoff_invoice_date, r.greedy_running_net_due_at_cutoff)
        for r in results.collect())
    assert got == brute_force(data, [Setting("active", 90, Decimal("0.50"))])


def test_an_empty_settings_table_finds_nothing(spark, edge):
    rows = recon_results(edge, active_relation(spark.createDataFrame([(2, 60, money(50))], STORED))).collect()
    assert len(rows) == 7
    assert {r.match_type for r in rows} == {"NO_INVOICES_IN_WINDOW"}


def test_probes_only_where_deep_days_are(spark, monkeypatch):
    """A payment that sees one or two crowded dates looks for amounts around those, not all over its window."""
    start = day("2024-01-01")
    flat = tables(
        spark,
        [(i, i % 20, start + datetime.timedelta(days=37 * (i // 20)), None, money(100 + i)) for i in range(80)],
        [(i, i % 20, money(100 + i), start + datetime.timedelta(days=37 * (i // 20) + 5), None) for i in range(80)],
    )
    counted = []
    real = matching._probes
    monkeypatch.setattr(matching, "_probes", lambda *a: counted.append(real(*a).count()) or real(*a))
    rows = recon_results(flat, [DEFAULT], inline_limit=0).collect()
    assert len(rows) == 80 and {r.match_type for r in rows} == {"SINGLE_MATCH"}
    assert counted[0] <= 80 * 2 * 2


def test_runs_hold_each_deep_day_once(spark):
    rng = random.Random(3)
    seen = [sorted(rng.sample(range(19000 - 60, 19001), n)) for n in (1, 2, 9, 30, 61)] + [[]]
    partly = spark.createDataFrame(
        [(k, datetime.date(1970, 1, 1) + datetime.timedelta(days=19000), money(5), 0, 5000, 500, 60, days)
         for k, days in enumerate(seen)],
        "customer_id long, payment_date date, payment_amount decimal(18,2), setting_no int, tolerance long, cents long, "
        "days_window int, deep_days array<int>",
    ).selectExpr("*", f"CAST(NULL AS {matching.HIT}) AS cut")
    got = {r.customer_id: r.runs for r in matching._queries(partly, [DEFAULT]).collect()}
    assert set(got) == {0, 1, 2, 3, 4}
    for k, runs in got.items():
        held = [d for r in runs for d in range(r.node << r.span, (r.node + 1) << r.span)]
        assert len(held) == len(set(held)) and set(seen[k]) <= set(held)
        assert min(held) >= 19000 - 60 and max(held) <= 19000


def test_crowded_rows_are_written_once(edge, monkeypatch):
    """The running totals of crowded dates are worked out by jobs of their own, not again in each branch of the plan."""
    names = []
    monkeypatch.setattr(matching, "written", lambda df, name, real=matching.written: names.append(name) or real(df, name))
    recon_results(edge, [DEFAULT], inline_limit=0)
    assert names == ["crowded", "chunks", "deep"]
