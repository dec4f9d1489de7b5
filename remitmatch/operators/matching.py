"""The payment matcher: one row per payment, without forming payment x invoice pairs.

A payment names only its customer. Its candidates are that customer's invoices dated in
the ``days_window`` days up to the payment. The matcher needs, per payment, the number and
sum of the candidates, the one closest in amount, and the first one (oldest first) at
which the running net due reaches the payment.

How it scales
-------------
Net dues are worked out once and written by their place in the ledger (customer, date, invoice_id);
everything below starts from those files. So are the running totals of crowded dates.

Invoices are folded into one row per (customer, block of days), holding a sorted array of
entries. A payment joins exactly one such row and works out everything from the array
inside that row: no pairs are shuffled and nothing is regrouped by payment. The join is
many-to-one, so adaptive execution can split a hot customer's payments freely.

An entry is one invoice, or, for a date on which the customer has more than
``inline_limit`` invoices (a *deep* day), one summary of that date. So an array holds at
most ``2 * (days_window + 1) * inline_limit`` entries, whatever the customer's size.

Only payments that see a deep day go on to an exact look-up that never pairs (``_deep_crossing``,
``_deep_closest``). The plan is the same for all data: where there are no deep days the branch is
empty and adaptive execution drops it while the job runs.

* The crossing invoice is the first at which the day's running total reaches what the payment
  still needs. The invoices that raise the total to a new maximum form a search tree over their
  row numbers: a node holds the highest totals of up to ``band_rows`` children, the leaves the invoices
  themselves. A payment goes down by one join per level. Nodes are cut by rows, not by value, so a huge
  invoice fills no node, and the joins are many-to-one, so any number of payments that end at one
  invoice can be split.
* The closest amount is found over a cover of the deep days in the window by runs of 1, 8, 64, ... days. The
  groups it sorts are cut by day run and by amount; they hold each amount once, so their size is bounded by the
  tolerance and the window. A payment looks only where it sees deep days, and only what it finds goes on.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitmatch.operators.ledger import (
    CHUNK,
    DAY,
    block_of,
    chunk_totals,
    day_totals,
    invoice_ledger,
    own_and_next_block,
    running_in_chunks,
)
from remitmatch.operators.netting import invoice_net_due
from remitmatch.session import written
from remitmatch.settings import Settings

INLINE_LIMIT = 8
BAND_ROWS = 1024
LEVELS = 2  # of the search tree below the root, which a day's own entry holds

# What decides a payment's outcome; payments alike in all four share one look-up.
QUERY = ["customer_id", "payment_date", "payment_amount", "setting_no"]

ROOT = "array<struct<high:bigint,child:bigint>>"
HIT = "struct<deep:boolean,day:date,invoice_id:bigint,before:bigint,running:bigint,node:bigint>"
PLACE = "struct<span:int,node:int,slice:bigint,value:bigint>"


def _cents(money: str) -> str:
    """Money as whole cents: folds and sorts run on BIGINT. Overflow raises, never wraps."""
    return f"CAST({money} * 100 AS BIGINT)"


def _money(cents: str, kind: str = "DECIMAL(28,2)") -> str:
    return f"CAST({cents} * CAST(0.01 AS DECIMAL(3,2)) AS {kind})"


SETTING = "struct<scenario:string,days_window:int,tolerance:bigint>"


def _bound(df: DataFrame, settings: Settings) -> DataFrame:
    """``df`` with the settings as columns: all of them, the longest look-back, the widest tolerance.

    Settings in a table stay in the plan as one-row subqueries, read when the job runs; the look-back is NULL
    without any, so nothing is in reach.
    """
    if isinstance(settings, DataFrame):
        rows = settings.select(F.expr(
            f"CAST(struct(scenario, days_window, tolerance_amount * 100) AS {SETTING}) AS setting"))
        return df.withColumns({
            "_settings": rows.agg(F.expr("sort_array(collect_list(setting))")).scalar(),
            "_width": rows.agg(F.expr("max(setting.days_window) + 1")).scalar(),
            "_widest": rows.agg(F.expr("coalesce(max(setting.tolerance), 0L)")).scalar(),
        })
    rows = ", ".join(f"struct('{s.scenario}', {s.days_window}, {int(s.tolerance * 100)})" for s in settings)
    return df.selectExpr(
        "*", f"CAST(array({rows}) AS array<{SETTING}>) AS _settings",
        f"{max((s.days_window + 1 for s in settings), default='CAST(NULL AS INT)')} AS _width",
        f"{int(max((s.tolerance for s in settings), default=Decimal(0)) * 100)}L AS _widest")


# Exponents of the aligned day runs that fit into the longest look-back.
SPANS = "sequence(0, length(bin(coalesce(_width, 1))) - 1, 3)"


def _amount_slice(cents: str) -> str:
    """Slice of an amount; payment +- tolerance never touches more than two of them, mostly one."""
    return f"floor(({cents}) / (4 * (2 * _widest + 1)))"


def _place(span: str, node: str, part: str, value: str) -> str:
    return f"CAST(struct({span}, {node}, {part}, {value}) AS {PLACE})"


def _entries(rows: DataFrame, settings: Settings, *values: str) -> DataFrame:
    """Rows as ledger entries, in every block whose payments can look back on them."""
    return _bound(rows, settings).selectExpr(
        "customer_id",
        f"{own_and_next_block('invoice_date', '_width')} AS block",
        f"""CAST(struct({', '.join(values)}) AS struct<
            day:date,invoice_id:bigint,net:bigint,n:bigint,high:bigint,deep:boolean,root:{ROOT}
        >) AS entry""",
    )


def _invoice_entries(invoices: DataFrame, settings: Settings) -> DataFrame:
    return _entries(
        invoices, settings,
        "invoice_date", "invoice_id", _cents("invoice_net_due"), "1", _cents("invoice_net_due"),
        "false", "NULL",
    )


def _day_entries(days: DataFrame, settings: Settings) -> DataFrame:
    return _entries(
        days, settings,
        "invoice_date", "NULL", _cents("day_sum"), "day_n", _cents("day_high"), "true", "root",
    )


def _blocks(entries: DataFrame) -> DataFrame:
    """One row per (customer, block): the sorted entries its payments can look back on."""
    # This side grows with the invoices, so it is never a broadcast.
    return (
        entries.groupBy("customer_id", "block")
        .agg(
            F.expr("sort_array(collect_list(entry)) AS entries"),
            F.expr("bool_or(entry.deep) AS has_deep"),
        )
        .hint("merge")
    )


def _first_reaching(children: str, need: str) -> str:
    """The first child whose highest total reaches ``need`` (children are in that order)."""
    return f"array_min(filter({children}, c -> c.high >= {need}))"


def _read_window(joined: DataFrame, settings: Settings, deep: bool = False) -> DataFrame:
    """Per payment and setting: count, sum, closest inline invoice and crossing entry.

    All of it in one generator, so the arrays are read where the join delivers them and
    carried no further. With ``deep`` also ``deep_days``, the numbers of the deep days in the window.
    """
    deep_days = """
                'deep_days', transform(filter(entries_seen, e -> e.deep), e -> unix_date(e.day)),""" if deep else ""
    crossing = f"""
        aggregate(
            entries_seen,
            named_struct('run', 0L, 'hit', CAST(NULL AS {HIT})),
            (state, e) -> CASE WHEN state.hit IS NOT NULL THEN state ELSE named_struct(
                'run', state.run + coalesce(e.net, 0L),
                'hit', CASE WHEN state.run + e.high >= cents THEN named_struct(
                    'deep', e.deep, 'day', e.day, 'invoice_id', e.invoice_id,
                    'before', state.run, 'running', state.run + e.net,
                    'node', {_first_reaching('e.root', 'cents - state.run')}.child
                ) END
            ) END,
            state -> state.hit
        )"""
    closest = """
        array_min(transform(
            filter(entries_seen, e -> NOT e.deep),
            e -> named_struct('abs_diff', abs(cents - e.net), 'invoice_id', e.invoice_id, 'net', e.net)
        ))"""
    reading = f"""
        transform(_settings, (setting, i) -> transform(
            array(filter(entries, e -> e.day BETWEEN date_sub(payment_date, setting.days_window)
                                                 AND payment_date)),
            entries_seen -> named_struct(
                'setting_no', i, 'scenario', setting.scenario,
                'days_window', setting.days_window, 'tolerance', setting.tolerance,
                'eligible_invoice_count', CASE WHEN size(entries_seen) > 0 THEN
                    aggregate(entries_seen, 0L, (n, e) -> n + e.n) END,
                'total', CASE WHEN size(entries_seen) > 0 THEN
                    aggregate(entries_seen, 0L, (total, e) -> total + coalesce(e.net, 0L)) END,
                'closest', {closest},{deep_days}
                'cut', {crossing}))[0])"""
    payment = ["payment_id", "customer_id", "payment_date", "payment_amount", "cents"]
    return _bound(joined, settings).selectExpr(*payment, f"explode_outer({reading}) AS reading").selectExpr(
        *payment, "reading.*"
    )


def _deep_rows(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Deep-day invoices in cents, with their row number and running total in the day.

    ``low`` is the highest total before the row (NULL for the first).
    """
    return rows.join(chunks.select(*CHUNK, "n_before", "sum_before", "high_before"), CHUNK).selectExpr(
        "customer_id", "unix_date(invoice_date) AS day", "invoice_id",
        "n_before + chunk_seq - 1 AS position",
        f"{_cents('invoice_net_due')} AS net",
        f"{_cents('(sum_before + chunk_run)')} AS run",
        f"{_cents('greatest(high_before, sum_before + chunk_high_before)')} AS low",
    )


def _tree(deep: DataFrame, fan: int) -> list[DataFrame]:
    """The search tree over the records of each day, from the root to the leaves.

    A record is an invoice that raises the day's running total to a new maximum. Each level has
    ``customer_id, day, node, children``, the children in order with the highest total below each;
    a leaf's children are the records. The root has no ``node``: it has one child for every
    ``fan ** LEVELS`` rows of the day.
    """
    level = deep.where("low IS NULL OR run > low").selectExpr(
        "customer_id", "day", "position", "run AS high", "invoice_id AS child")
    found = []
    for _ in range(LEVELS):
        level = (
            level.withColumn("position", F.expr(f"position DIV {fan}"))
            .groupBy("customer_id", "day", "position")
            .agg(F.expr("sort_array(collect_list(struct(high, child))) AS children"), F.max("high").alias("high"))
        )
        found.append(level.selectExpr("customer_id", "day", "position AS node", "children"))
        level = level.selectExpr("customer_id", "day", "position", "high", "position AS child")
    root = level.groupBy("customer_id", "day").agg(F.expr("sort_array(collect_list(struct(high, child))) AS root"))
    return [root, *reversed(found)]


def _deep_crossing(queries: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Queries with ``deep_cut``, the record inside a deep day at which they are reached (NULL: none)."""
    kept = [c for c in queries.columns if c != "node"]
    for nodes in levels:
        # the tree's side grows with the invoices, so it is never a broadcast
        queries = (
            queries.join(nodes.hint("merge"), ["customer_id", "day", "node"], "left")
            .selectExpr(*kept, f"{_first_reaching('children', 'need')} AS hit")
            .selectExpr(*kept, "hit", "hit.child AS node")
        )
    return queries.selectExpr(*kept, "struct(hit.high AS value, hit.child AS invoice_id) AS deep_cut")


def _amounts(deep: DataFrame, settings: Settings) -> DataFrame:
    """Deep-day invoices filed under every group in which a payment may look up an amount.

    Under span k, by the aligned run of 2**k days that holds the date and by the slice of the
    amount; of equal amounts only the lowest id is kept.
    """
    as_amount = f"""
        transform({SPANS}, span -> {_place(
            'span', 'shiftright(day, span)', _amount_slice('net'), 'net'
        )})"""
    return (
        _bound(deep, settings).selectExpr("customer_id", "invoice_id", f"explode({as_amount}) AS place")
        .groupBy("customer_id", "place")
        .agg(F.min("invoice_id").alias("invoice_id"))
        .selectExpr(
            "customer_id", "place.*", "struct(place.value, invoice_id) AS invoice", "0 AS is_query"
        )
    )


def _queries(partly: DataFrame, settings: Settings) -> DataFrame:
    """The different look-ups of the payments that see deep days.

    ``runs`` are the longest aligned day runs inside the window around each deep day; over all deep days
    they hold every one of them once.
    """
    inside = """
        shiftleft(shiftright(day, span), span) >= unix_date(payment_date) - days_window
        AND shiftleft(shiftright(day, span) + 1, span) - 1 <= unix_date(payment_date)"""
    runs = f"""
        array_distinct(transform(
            transform(deep_days, day -> struct(day, array_max(filter({SPANS}, span -> {inside})) AS span)),
            run -> struct(run.span AS span, shiftright(run.day, run.span) AS node)))"""
    return _bound(partly.where("size(deep_days) > 0"), settings).selectExpr(
        *QUERY, "tolerance", "cents", f"{runs} AS runs", "unix_date(cut.day) AS day",
        "cents - cut.before AS need", "cut.node AS node",
    ).distinct()


def _probes(queries: DataFrame, settings: Settings) -> DataFrame:
    """The groups in which each payment's closest amounts lie."""
    slices = f"""
        array_distinct(array({_amount_slice('cents - tolerance')},
                             {_amount_slice('cents + tolerance')}))"""
    by_amount = f"""
        flatten(transform(runs, run ->
            transform({slices}, part -> {_place('run.span', 'run.node', 'part', 'cents')})))"""
    return (
        _bound(queries, settings)
        .selectExpr(*QUERY, "tolerance", f"explode({by_amount}) AS place")
        .selectExpr(*QUERY, "tolerance", "place.*", "1 AS is_query")
    )


def _deep_closest(queries: DataFrame, amounts: DataFrame, settings: Settings) -> DataFrame:
    """``deep_closest``, close deep-day invoices within the tolerance of each query, the closest among them.

    In each group payments and invoices are sorted together, so the neighbours of a
    payment are the last invoice seen on the way up and on the way down.
    """
    neighbour = """
        last(invoice, true) OVER (PARTITION BY customer_id, span, node, slice
                                  ORDER BY value {direction}, is_query
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    candidate = """
        CASE WHEN abs(value - {side}.value) <= tolerance THEN
            named_struct('abs_diff', abs(value - {side}.value), 'invoice_id', {side}.invoice_id,
                         'net', {side}.value) END"""
    return (
        _probes(queries, settings)
        .unionByName(amounts, allowMissingColumns=True)
        .selectExpr(
            "*",
            f"{neighbour.format(direction='ASC')} AS below",
            f"{neighbour.format(direction='DESC')} AS above",
        )
        .where("is_query = 1")
        .selectExpr(
            *QUERY, f"least({candidate.format(side='below')}, {candidate.format(side='above')}) AS deep_closest")
        .where("deep_closest IS NOT NULL")
    )


def has_deep_days(invoices: DataFrame, inline_limit: int = INLINE_LIMIT) -> bool:
    """Whether any customer has more than ``inline_limit`` invoices on one date.

    Runs one aggregation over two columns of the invoices.
    """
    sizes = invoices.groupBy(*DAY).agg(F.count("*").alias("day_n"))
    return not sizes.where(f"day_n > {inline_limit}").isEmpty()


def match_payments(
    payments: DataFrame,
    invoices: DataFrame,
    credits: DataFrame,
    returns: DataFrame,
    settings: Settings,
    *,
    deep_days: bool = True,
    inline_limit: int = INLINE_LIMIT,
    parts: int | None = None,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per payment and setting.

    All settings are answered from one pass over the invoices. They are a list, or a table (``scenario,
    days_window, tolerance_amount``) that the plan reads when it runs. With none, every payment
    comes out once with no eligible invoices. Ties for the closest amount go to the lowest
    invoice_id. ``deep_days=False`` reads every date inline and leaves out the look-up;
    results are the same, but an array then holds all invoices of a crowded date. The net dues and the crowded
    dates' running totals are written to the shared folder while the plan is made; ``band_rows`` is the number of
    children of a node of the search tree (two at least).

    Columns: payment_id, customer_id, payment_date, payment_amount, scenario,
    eligible_invoice_count and sum_net_due (NULL when there are none), ``single``
    (abs_diff, invoice_id, net; NULL beyond the tolerance), ``cutoff`` (invoice_id, day,
    running; NULL when the payment is never reached).
    """
    net = invoice_net_due(invoices, credits, returns).select(
        *DAY, "invoice_id", "invoice_net_due"
    )
    placed = _bound(payments, settings).selectExpr(
        "payment_id", "customer_id", "payment_date", "payment_amount",
        f"{_cents('payment_amount')} AS cents",
        f"{block_of('payment_date', '_width')} AS block",
    )
    outcome = [
        "payment_id", "customer_id", "payment_date", "payment_amount", "scenario",
        "eligible_invoice_count", f"{_money('total')} AS sum_net_due",
    ]
    single = f"""
        CASE WHEN {{0}}.abs_diff <= tolerance THEN named_struct(
            'abs_diff', {_money('{0}.abs_diff')}, 'invoice_id', {{0}}.invoice_id,
            'net', {_money('{0}.net')}) END AS single"""
    cutoff = f"""
        CASE WHEN cut.deep THEN named_struct(
            'invoice_id', {{deep_id}}, 'day', cut.day, 'running', {_money('({deep_run})')})
        WHEN cut IS NOT NULL THEN named_struct(
            'invoice_id', cut.invoice_id, 'day', cut.day, 'running', {_money('cut.running')})
        END AS cutoff"""

    def shallow(joined: DataFrame) -> DataFrame:
        return _read_window(joined, settings).selectExpr(
            *outcome,
            single.format("closest"),
            cutoff.format(deep_id="cut.invoice_id", deep_run="cut.running"),
        )

    on_block = ["customer_id", "block"]
    if not deep_days:
        return shallow(placed.join(_blocks(_invoice_entries(net, settings)), on_block, "left"))

    fan = max(2, band_rows)
    ledger = invoice_ledger(net, parts)
    crowded = ledger.groupBy(*DAY).agg(F.count("*").alias("day_n")).where(f"day_n > {inline_limit}")
    # What follows reads these in several places with different columns, so they are written once.
    rows = written(running_in_chunks(ledger.join(crowded, DAY)), "crowded")
    chunks = written(chunk_totals(rows), "chunks")
    deep = written(_deep_rows(rows, chunks), "deep")
    root, *levels = _tree(deep, fan)
    days = day_totals(chunks).join(
        root.withColumn("invoice_date", F.date_from_unix_date("day")).drop("day"), DAY)
    joined = placed.join(
        _blocks(
            _invoice_entries(ledger.join(crowded, DAY, "left_anti"), settings).unionByName(
                _day_entries(days, settings)
            )
        ),
        on_block,
        "left",
    )
    partly = _read_window(joined.where("has_deep"), settings, deep=True)
    queries = _queries(partly, settings)
    crossed = _deep_crossing(
        queries.where("node IS NOT NULL").select(*QUERY, "day", "need", "node"), levels).select(*QUERY, "deep_cut")
    found = (
        crossed.unionByName(_deep_closest(queries, _amounts(deep, settings), settings), allowMissingColumns=True)
        .groupBy(*QUERY).agg(F.expr("first(deep_cut, true) AS deep_cut"), F.min("deep_closest").alias("deep_closest"))
    )
    return shallow(joined.where("NOT coalesce(has_deep, false)")).unionByName(
        partly.join(found, QUERY, "left")
        .withColumn("closest", F.expr("least(closest, deep_closest)"))
        .selectExpr(
            *outcome,
            single.format("closest"),
            cutoff.format(deep_id="deep_cut.invoice_id", deep_run="cut.before + deep_cut.value"),
        )
    )
