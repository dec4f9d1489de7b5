"""Views of the supplied test tables in the engine's own table layouts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitmatch.operators.validation import CURRENCIES, RETURN_STATUSES
from remitmatch.operators.validation import PAYMENT_METHODS as METHODS
from remitmatch.operators.validation import RETURN_REASONS as REASONS
from remitmatch.schemas import MONEY

AS_OF = datetime.date(2001, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# --- flat track ----------------------------------------------------------------------


def flat_tables(spark: SparkSession, sf_dir: str, owners: bool = False) -> dict[str, DataFrame]:
    """The five flat tables.

    Credits and returns name their customer only with ``owners``: the matcher never reads
    it, and it costs a join.
    """
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    key = F.col("o_orderkey")
    total = _money("o_totalprice")
    # One order in a hundred goes to one of two busy customers on one of three dates; one in
    # 41 names a customer that is not in the table.
    busy = key % 100 == 1
    ordered = F.when(busy, F.date_add(F.lit(datetime.date(1995, 6, 16)), (key % 3).cast("int"))).otherwise(
        F.to_date("o_orderdate"))
    holder = (
        F.when(busy, F.lit(20000000) + F.floor(key / 100) % 2)
        .when(key % 41 == 0, F.col("o_custkey") + 10000000).otherwise(F.col("o_custkey"))
    )

    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("industry"),
    )
    invoices = orders.select(
        key.alias("invoice_id"),
        holder.alias("customer_id"),
        ordered.alias("invoice_date"),
        F.date_add(ordered, 30).alias("due_date"),
        total.alias("invoice_amount"),
    )
    amount = (
        F.when(key % 5 == 1, total + 30)
        .when(key % 5 == 2, total * F.lit("0.6").cast("decimal(2,1)"))
        .when(key % 5 == 3, total * F.lit("1.6").cast("decimal(2,1)"))
        .otherwise(total)
    )
    delay = F.when(key % 5 == 4, 90).otherwise(key % 45).cast("int")
    notes = F.concat(
        F.when(key % 2 == 0, "INV").otherwise("inv"), key.cast("string"),
        F.lit(" + INV"), (key + 1).cast("string"),
        F.when(key % 3 == 0, " less credit").otherwise(""),
        F.when(key % 7 == 0, F.concat(F.lit(" + INV"), key.cast("string"), F.lit(" XINV9"))).otherwise(""),
    )
    payments = orders.select(
        key.alias("payment_id"),
        holder.alias("customer_id"),
        amount.cast(MONEY).alias("payment_amount"),
        F.date_add(ordered, delay).alias("payment_date"),
        notes.alias("reference_notes"),
    )

    def lines(flag: str, rate: str) -> DataFrame:
        summed = (
            lineitem.where(F.col("l_returnflag") == flag)
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                (F.sum(_money("l_extendedprice")) * F.lit(rate).cast("decimal(3,2)"))
                .cast(MONEY)
                .alias("credit_amount"),
                F.bool_and(F.col("l_linestatus") == "F").alias("finished"),
                F.min("l_partkey").alias("part"),
            )
            .withColumn("line_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        )
        if not owners:
            return summed
        owner = orders.select(key.alias("l_orderkey"), holder.alias("customer_id"))
        return summed.join(owner, "l_orderkey")

    owner_column = ["customer_id"] if owners else []

    credits = lines("A", "0.10").select(
        F.col("line_id").alias("credit_id"),
        *owner_column,
        "credit_amount",
        F.when(F.col("finished"), F.col("l_orderkey")).alias("applied_invoice_id"),
    )
    returns = lines("R", "0.05").select(
        F.col("line_id").alias("return_id"),
        *owner_column,
        F.when(F.col("l_orderkey") % 10 < 7, F.col("l_orderkey"))
        .otherwise(F.col("l_orderkey") + 100000000)
        .alias("original_invoice_id"),
        F.concat(F.lit("SKU_"), (F.col("part") % 1001 + 1000).cast("string")).alias("return_sku"),
        "credit_amount",
    )
    return {
        "customers": customers, "invoices": invoices, "payments": payments,
        "returns": returns, "credits": credits,
    }


# --- documents and warehouse tables ----------------------------------------------------


def _at(values: list[str], index: str) -> str:
    names = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({names}), CAST({index} AS INT) + 1)"


def _invoice_ref(key: str, orphan_every: int | None = None) -> str:
    offset = "1000000"
    if orphan_every:
        offset = f"CASE WHEN {key} % {orphan_every} = 0 THEN 900000000 ELSE 1000000 END"
    return f"concat('INV-', {key} + {offset})"


CUSTOMER_REF = "concat('CUST-', o_custkey + 1000000)"


def _by_order(lines: DataFrame, *columns: str) -> DataFrame:
    """Line items placed by their order once: grouping by line, by order and joining orders all start from there."""
    return lines.select("l_orderkey", "l_linenumber", *columns).repartition("l_orderkey")


def _invoices_of(orders: DataFrame, *more: str) -> DataFrame:
    """The invoices with the key of their order and ``more`` columns."""
    return (
        orders.selectExpr(
            "o_orderkey", "o_orderstatus", *more,
            f"{_invoice_ref('o_orderkey')} AS invoice_id",
            f"{CUSTOMER_REF} AS customer_id",
            "to_date(o_orderdate) AS order_date",
            "CASE WHEN o_orderkey % 17 <> 0 THEN date_add(to_date(o_orderdate), 30) END AS due_date",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount",
            f"{_at(CURRENCIES, 'o_orderkey % 6')} AS currency",
            """CASE WHEN o_orderkey % 23 = 0 THEN 'VOID' WHEN o_orderstatus = 'F' THEN 'PAID'
                    WHEN o_orderstatus = 'P' THEN 'PARTIAL' WHEN o_orderkey % 2 = 0 THEN 'OVERDUE'
                    ELSE 'OPEN' END AS status""",
        )
        .selectExpr(
            "o_orderkey", "invoice_id", "customer_id", "order_date", "due_date", "total_amount",
            """CAST(CASE status WHEN 'PAID' THEN total_amount
                    WHEN 'PARTIAL' THEN total_amount * CAST(0.5 AS DECIMAL(2,1))
                    ELSE 0 END AS DECIMAL(18,2)) AS amount_paid""",
            "currency", "status", *more,
        )
    )


def ar_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _invoices_of(table(spark, sf_dir, "orders")).drop("o_orderkey")


def ar_invoice_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoices with an older version of every nineteenth."""
    now = ar_invoices(spark, sf_dir)
    older = now.where("CAST(substring(invoice_id, 5) AS BIGINT) % 19 = 0").withColumns({
        "order_date": F.date_sub("order_date", 1), "total_amount": F.expr("CAST(total_amount + 7 AS DECIMAL(18,2))")})
    return now.unionByName(older)


def ar_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        _by_order(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_shipdate")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.expr("sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS line_amount"),
            F.expr("to_date(min(l_shipdate)) AS payment_date"),
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return lines.join(orders, F.expr("o_orderkey = l_orderkey")).selectExpr(
        "concat('PMT-', l_orderkey * 10 + l_linenumber + 1000000) AS payment_id",
        f"{_invoice_ref('l_orderkey', 97)} AS invoice_id",
        f"{CUSTOMER_REF} AS customer_id",
        "payment_date",
        """CAST(CASE WHEN l_linenumber = 1 AND l_orderkey % 4 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2))
                ELSE line_amount END AS DECIMAL(18,2)) AS amount_paid""",
        f"{_at(METHODS, 'l_linenumber - 1')} AS payment_method",
        "CASE WHEN l_orderkey % 4 <> 1 THEN concat('REF-', l_orderkey) END AS reference_number",
        """CASE (l_orderkey + l_linenumber) % 8 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'FAILED'
             WHEN 2 THEN 'REVERSED' WHEN 3 THEN 'PARTIAL' WHEN 4 THEN 'PARTIAL' ELSE 'CLEARED' END AS status""",
    )


def _returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")


def _keyed_return_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the returns with the key of their order."""
    return (
        _by_order(_returned(spark, sf_dir), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.expr("min(l_partkey) AS pk"),
            F.expr("min(l_suppkey) AS sk"),
            F.expr("CAST(sum(l_quantity) AS INT) AS quantity"),
            F.expr("min(CAST(l_extendedprice AS DECIMAL(18,2))) AS lowest"),
        )
        .selectExpr(
            "l_orderkey", "concat('RET-', l_orderkey + 1000000) AS return_id",
            "l_linenumber AS line_no",
            f"concat({_at(['SKU-PRMA', 'SKU-PRMB', 'SKU-ALPH', 'SKU-BETA'], 'pk % 4')}, pk) AS original_sku",
            """CASE WHEN sk % 3 <> 0 THEN concat(element_at(array('SKU-PRMA', 'SKU-PRMB', 'SKU-ALPH', 'SKU-BETA'),
                                                           CAST(pk % 4 AS INT) + 1), pk)
                    ELSE concat(element_at(array('SKU-PRMB', 'SKU-PRMA', 'SKU-GAMM', 'SKU-GAMM'),
                                           CAST(pk % 4 AS INT) + 1), pk) END AS returned_sku""",
            "quantity",
            "CAST(lowest * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,4)) AS unit_price",
        )
    )


def ar_return_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_return_lines(spark, sf_dir).drop("l_orderkey")


def _keyed_return_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The return headers with the key of their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        _returned(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(F.expr("to_date(max(l_shipdate)) AS return_date"))
        .join(orders, F.expr("o_orderkey = l_orderkey"))
        .selectExpr(
            "l_orderkey", "concat('RET-', l_orderkey + 1000000) AS return_id",
            f"{_invoice_ref('l_orderkey', 89)} AS original_invoice_id",
            f"{CUSTOMER_REF} AS customer_id",
            "return_date",
            f"{_at(REASONS, 'l_orderkey % 8')} AS reason_code",
            f"{_at(RETURN_STATUSES, 'l_orderkey % 5')} AS status",
        )
    )


def return_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_return_headers(spark, sf_dir).drop("l_orderkey")


def ar_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return headers with the denormalised mismatch flag."""
    flags = (
        _keyed_return_lines(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(F.expr("bool_or(original_sku <> returned_sku) AS sku_mismatch_flag"))
    )
    return _keyed_return_headers(spark, sf_dir).join(flags, "l_orderkey").drop("l_orderkey")


def _keyed_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the invoices with the key of their order."""
    return (
        _by_order(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", "l_extendedprice")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.expr("min(l_partkey) AS pk"),
            F.expr("CAST(sum(l_quantity) AS INT) AS quantity"),
            F.expr("min(CAST(l_extendedprice AS DECIMAL(18,2))) AS lowest"),
        )
        .selectExpr(
            "l_orderkey", f"{_invoice_ref('l_orderkey')} AS invoice_id",
            "l_linenumber AS line_no",
            "concat('SKU-', lpad(pk, 6, '0')) AS sku",
            "quantity",
            "CAST(lowest * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,4)) AS unit_price",
        )
    )


def ar_invoice_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_invoice_lines(spark, sf_dir).drop("l_orderkey")


def ar_payment_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ar_payments(spark, sf_dir)
        .where("status IN ('CLEARED', 'PARTIAL')")
        .selectExpr(
            "payment_id", "invoice_id",
            """CAST(CASE status WHEN 'CLEARED' THEN amount_paid
                    ELSE amount_paid * CAST(0.5 AS DECIMAL(2,1)) END AS DECIMAL(18,2)) AS allocated""",
            "payment_date AS allocation_date",
        )
        # most payments are allocated in two steps
        .selectExpr(
            "payment_id", "invoice_id", "allocation_date",
            """explode(CASE WHEN allocated < 2 THEN array(allocated) ELSE array(
                 CAST(1 AS DECIMAL(18,2)), CAST(allocated - 1 AS DECIMAL(18,2))) END) AS allocated_amount""",
        )
        .select("payment_id", "invoice_id", "allocated_amount", "allocation_date")
    )


def invoice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with their lines nested, at most one line per line number."""
    lines = (
        _keyed_invoice_lines(spark, sf_dir)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.expr(
                """transform(array_sort(collect_list(struct(line_no, sku, quantity, unit_price))),
                   l -> named_struct('sku', l.sku, 'description', CAST(NULL AS STRING),
                                     'quantity', l.quantity, 'unit_price', l.unit_price)) AS line_items"""
            )
        )
    )
    # Both sides grow with the data: never a broadcast. Orders are joined as they are, which is less to shuffle.
    orders = table(spark, sf_dir, "orders").join(lines.hint("merge"), "o_orderkey", "left")
    return (
        _invoices_of(orders, "line_items")
        .drop("o_orderkey")
        .withColumn("notes", F.lit(None).cast("string"))
    )


def return_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns with their lines nested."""
    lines = (
        _keyed_return_lines(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(
            F.expr(
                """transform(array_sort(collect_list(struct(line_no, original_sku, returned_sku, quantity, unit_price))),
                   l -> named_struct('original_sku', l.original_sku, 'returned_sku', l.returned_sku,
                                     'quantity', l.quantity, 'unit_price', l.unit_price,
                                     'notes', CAST(NULL AS STRING))) AS line_items"""
            )
        )
    )
    return _keyed_return_headers(spark, sf_dir).join(lines.hint("merge"), "l_orderkey").drop("l_orderkey")


# --- raw text records, some of them broken on purpose ------------------------------------


def _text_lines(fields: list[tuple[str, str]], literal: str) -> str:
    """``line_items`` as JSON text, or as Python-literal text where ``literal`` holds."""
    def text(quote: str) -> str:
        parts = [f"'{quote}{name}{quote}: ', {value.replace('<q>', quote)}" for name, value in fields]
        return (
            "concat('[', array_join(transform(line_items, l -> concat('{', "
            + ", ', ', ".join(parts)
            + ", '}')), ', '), ']')"
        )

    return f"CASE WHEN {literal} THEN {text(chr(92) + chr(39))} ELSE {text(chr(34))} END"


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = """CASE WHEN k % 67 = 0 THEN '0' WHEN k % 29 = 0 THEN concat('"', l.quantity, '"')
                       WHEN k % 31 = 0 THEN concat(l.quantity, '.7') ELSE CAST(l.quantity AS STRING) END"""
    lines = _text_lines(
        [
            ("sku", "'<q>', l.sku, '<q>'"),
            ("description", "CASE WHEN k % 13 = 0 THEN 'None' ELSE 'null' END"),
            ("quantity", quantity),
            ("unit_price", "CAST(l.unit_price AS STRING)"),
        ],
        "k % 13 = 0",
    )
    return (
        invoice_documents(spark, sf_dir)
        .selectExpr("*", "CAST(substring(invoice_id, 5) AS BIGINT) - 1000000 AS k")
        .selectExpr(
            "CASE WHEN k % 43 = 0 THEN 'INV-12' ELSE invoice_id END AS invoice_id",
            "customer_id",
            "CAST(order_date AS STRING) AS order_date",
            "CASE WHEN k % 61 = 0 THEN 'soon' ELSE CAST(due_date AS STRING) END AS due_date",
            f"CASE WHEN k % 59 = 0 THEN '[]' ELSE {lines} END AS line_items",
            "CASE WHEN k % 47 = 0 THEN 'abc' ELSE CAST(total_amount AS STRING) END AS total_amount",
            "CAST(CASE WHEN k % 53 = 0 THEN total_amount + 1 ELSE amount_paid END AS STRING) AS amount_paid",
            "CASE WHEN k % 71 = 0 THEN NULL WHEN k % 41 = 0 THEN 'XYZ' ELSE currency END AS currency",
            "CASE WHEN k % 73 = 0 THEN 'LOST' ELSE status END AS status",
            """CASE WHEN k % 7 = 0 THEN 'said "call, later"' END AS notes""",
        )
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ar_payments(spark, sf_dir)
        .selectExpr("*", "CAST(substring(payment_id, 5) AS BIGINT) - 1000000 AS k")
        .selectExpr(
            "CASE WHEN k % 61 = 0 THEN 'PMT-1' ELSE payment_id END AS payment_id",
            "invoice_id", "customer_id",
            "CASE WHEN k % 59 = 0 THEN '2024-13-01' ELSE CAST(payment_date AS STRING) END AS payment_date",
            """CASE WHEN k % 67 = 0 THEN NULL WHEN k % 41 = 0 THEN '0.00' WHEN k % 43 = 0 THEN '-5.00'
                    ELSE CAST(amount_paid AS STRING) END AS amount_paid""",
            "CASE WHEN k % 47 = 0 THEN 'BARTER' ELSE payment_method END AS payment_method",
            "reference_number",
            "CASE WHEN k % 53 = 0 THEN 'UNKNOWN' ELSE status END AS status",
            "CAST(NULL AS STRING) AS notes",
        )
    )


def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _text_lines(
        [
            ("original_sku", "'<q>', CASE WHEN k % 47 = 0 THEN 'BAD' ELSE l.original_sku END, '<q>'"),
            ("returned_sku", "'<q>', l.returned_sku, '<q>'"),
            ("quantity", "CAST(l.quantity AS STRING)"),
            ("unit_price", "CAST(l.unit_price AS STRING)"),
            ("notes", "CASE WHEN k % 13 = 0 THEN 'None' ELSE 'null' END"),
        ],
        "k % 13 = 0",
    )
    return (
        return_documents(spark, sf_dir)
        .selectExpr("*", "CAST(substring(return_id, 5) AS BIGINT) - 1000000 AS k")
        .selectExpr(
            "return_id", "original_invoice_id",
            "CASE WHEN k % 59 <> 0 THEN customer_id END AS customer_id",
            "CAST(return_date AS STRING) AS return_date",
            f"CASE WHEN k % 53 = 0 THEN '[]' ELSE {lines} END AS line_items",
            "CASE WHEN k % 41 = 0 THEN 'BORED' ELSE reason_code END AS reason_code",
            "CASE WHEN k % 43 = 0 THEN 'LOST' ELSE status END AS status",
            "CASE WHEN k % 5 = 4 THEN concat('CM-', k) END AS credit_memo_id",
            "CAST(NULL AS STRING) AS notes",
        )
    )


RAW = {"invoices": raw_invoices, "payments": raw_payments, "returns": raw_returns}
