"""Driver tables → the eight raw input tables of the mart pipeline.

The driver ships a TPC-H-like star (region, nation, customer, supplier, part,
orders, lineitem). This module derives, with plain DataFrame operations, the
raw tables the pipeline consumes: territories, products, customers, reps,
orders (one row per order line), returns, costs and mrr_events.

Raw tables here are already typed (the source is Parquet); the CSV ingest
path (``sources.csv_ingest``) produces the same columns as text, and the
staging step casts either form the same way.

Scale notes: the only large joins are order line ⋈ order header on the order
key (a sort-merge join on both sides' hash partitioning) and the lookups to
supplier, which go through the size-checked ``lookup_join``. Order ids are a
deterministic hash of the whole line, so no window or extra shuffle is needed
to number lines within an order, and a hot order key costs nothing extra.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.functions.exact import div_round, double_cents, from_cents, idiv, sum_money
from quillmart.operators.mrr import classify_mrr
from quillmart.plans.joins import HOME, lookup_join, near_lookup
from quillmart.sources.driver import read_table

# --- fixed values: adapter parameters ---------------------------------------
LAUNCH_EPOCH = dt.date(1985, 1, 1)
LAUNCH_SPREAD_DAYS = 3650
CONTRACT_EPOCH = dt.date(1995, 1, 1)
CONTRACT_SPREAD_DAYS = 700
CONTRACT_LENGTH_DAYS = 365
HIRE_EPOCH = dt.date(1990, 1, 1)
HIRE_SPREAD_DAYS = 1795
TIER_A_MIN_BALANCE = 6667
TIER_B_MIN_BALANCE = 1000
STANDARD_COST_PCT = 40          # unit cost = 40 % of retail price
QUOTA_BASE_CENTS = 80_000_000   # 800,000.00
QUOTA_PER_BALANCE = 200
COST_SWING_MOD = 17             # actual cost = standard × (92 .. 108) %
COST_SWING_OFFSET = 8
RETURNED = "R"                  # flag of the lines that have a return


def _d(x: dt.date):
    return F.lit(x.isoformat()).cast("date")


def _nations(spark, sf_dir) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return lookup_join(nation, region, "n_regionkey")


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _nations(spark, sf_dir)
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("territory_id"),
        F.col("n_name").alias("territory_name"),
        F.col("r_name").alias("region"),
        F.lit("US").alias("country"),
        F.concat(F.lit("Z"), (F.col("n_nationkey") % 5).cast("string")).alias("zone"),
    )


def product_line_of(p_type) -> F.Column:
    t = F.col(p_type)
    return (F.when(t.startswith("PROMO"), "Biologics")
            .when(t.startswith("LARGE"), "Specialty")
            .when(t.startswith("STANDARD") | t.startswith("MEDIUM"), "Primary Care")
            .otherwise("Generics"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("therapeutic_area"),
        product_line_of("p_type").alias("product_line"),
        F.substring_index("p_type", " ", -1).alias("formulation"),  # the material
        F.date_add(_d(LAUNCH_EPOCH), (F.col("p_partkey") % LAUNCH_SPREAD_DAYS).cast("int")).alias("launch_date"),
        from_cents(div_round(double_cents("p_retailprice") * STANDARD_COST_PCT, F.lit(100)))
        .cast("decimal(14,2)").alias("unit_cost_standard"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = _nations(spark, sf_dir).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    c = lookup_join(c, n, "c_nationkey")
    start = F.date_add(_d(CONTRACT_EPOCH), (F.col("c_custkey") % CONTRACT_SPREAD_DAYS).cast("int"))
    bal = F.col("c_acctbal")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("segment"),
        F.when(bal >= TIER_A_MIN_BALANCE, "A").when(bal >= TIER_B_MIN_BALANCE, "B")
        .otherwise("C").alias("tier"),
        F.col("r_name").alias("region"),
        F.col("c_nationkey").cast("bigint").alias("territory_id"),
        start.alias("contract_start_date"),
        F.when(bal < 0, F.date_add(start, CONTRACT_LENGTH_DAYS)).alias("contract_end_date"),
        (bal >= 0).alias("is_active"),
    )


def reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = _nations(spark, sf_dir).select(F.col("n_nationkey").alias("s_nationkey"), "r_name")
    s = lookup_join(s, n, "s_nationkey")
    quota_c = F.lit(QUOTA_BASE_CENTS) + F.greatest(double_cents("s_acctbal"), F.lit(0)) * QUOTA_PER_BALANCE
    return s.select(
        F.col("s_suppkey").alias("rep_id"),
        F.col("s_name").alias("rep_name"),
        F.col("s_nationkey").cast("bigint").alias("territory_id"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("MGR-"), (F.col("s_suppkey") % 5).cast("string")).alias("manager_name"),
        F.date_add(_d(HIRE_EPOCH), (F.col("s_suppkey") % HIRE_SPREAD_DAYS).cast("int")).alias("hire_date"),
        from_cents(quota_c).cast("decimal(14,2)").alias("annual_quota"),
    )


def line_home(li: DataFrame):
    """The order key; for a line without one the first number that its order id is made of, so that
    equal order ids have equal homes. Never null."""
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.coalesce(*[F.col(c).cast("bigint") for c in parts], F.lit(0).cast("bigint"))


def line_ids(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """For each id of a sales fact that may lead to a large dimension: all pairs of ``HOME`` and that id (and
    maybe more), by a scan."""
    li = read_table(spark, sf_dir, "lineitem")
    oh = read_table(spark, sf_dir, "orders")
    return {
        "product_id": li.select(line_home(li).alias(HOME), F.col("l_partkey").alias("product_id")),
        "customer_id": oh.select(F.col("o_orderkey").cast("bigint").alias(HOME), F.col("o_custkey").alias("customer_id")),
        "rep_id": li.select(line_home(li).alias(HOME), F.col("l_suppkey").alias("rep_id")),
    }


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to their order header and priced (internal frame).

    Rows lie by ``HOME``, so that what is joined or grouped by it and the order id stays there.

    Prices follow the order price build-up (E1): list price per unit from the
    extended price, discount in whole percent, net price and amounts rounded
    to the cent half up, all on integer cents.
    """
    li = read_table(spark, sf_dir, "lineitem")
    li = li.select(line_home(li).alias(HOME), F.col("l_orderkey").isNotNull().alias("_keyed"),
                   *[c for c in li.columns if c != "l_orderkey"])
    oh = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_o"), "o_custkey", "o_orderdate")
    # Both sides grow with the data: always a shuffle (sort-merge) join on the
    # order key, never a broadcast of the order headers.
    j = li.join(oh.hint("merge"), (F.col(HOME) == F.col("_o")) & F.col("_keyed"), "left")  # a line without header stays visible to the checks
    sup = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = near_lookup(j, sup, "l_suppkey", li)
    qty = F.rint(F.col("l_quantity")).cast("int")
    ext_c = double_cents("l_extendedprice")
    disc_p = double_cents("l_discount").cast("int")
    tax_p = double_cents("l_tax").cast("int")
    ship = F.col("l_shipdate").cast("date")
    order_id = F.md5(F.concat_ws(
        "|", *[c.cast("string") for c in (
            F.when(F.col("_keyed"), F.col(HOME)), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
            qty, ext_c, disc_p, tax_p, F.col("l_returnflag"), F.col("l_linestatus"), ship)]))
    j = j.select(
        order_id.alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("rep_id"),
        F.col("s_nationkey").cast("bigint").alias("territory_id"),
        qty.alias("quantity"),
        ext_c.alias("_ext_c"),
        disc_p.alias("_disc_p"),
        F.col("l_linenumber"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        HOME,
    )
    list_c = F.when(F.col("quantity") > 0,
                    div_round(F.col("_ext_c"), F.col("quantity"))).otherwise(F.col("_ext_c"))
    j = j.withColumn("_list_c", list_c)
    j = j.withColumn("_net_price_c", div_round(F.col("_list_c") * (100 - F.col("_disc_p")), F.lit(100)))
    return j


def orders(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    j = lines if lines is not None else order_lines(spark, sf_dir)
    money = "decimal(14,2)"
    return j.select(
        "order_id", "order_date", "product_id", "customer_id", "rep_id", "territory_id", "quantity",
        from_cents(F.col("_list_c")).cast(money).alias("list_price"),
        from_cents(F.col("_disc_p"), 2).cast("decimal(8,6)").alias("discount_pct"),
        from_cents(F.col("_net_price_c")).cast(money).alias("net_price"),
        from_cents(F.col("_list_c") * F.col("quantity")).cast(money).alias("gross_amount"),
        from_cents(F.col("_net_price_c") * F.col("quantity")).cast(money).alias("net_amount"),
        *carry,
    )


def returns(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    j = lines if lines is not None else order_lines(spark, sf_dir)
    return j.where(F.col("l_returnflag") == RETURNED).select(
        F.concat(F.lit("R-"), F.col("order_id")).alias("return_id"),
        "order_id",
        F.date_add("order_date", (F.col("l_linenumber") + 1).cast("int")).alias("return_date"),
        F.greatest(idiv(F.col("quantity"), F.lit(2)), F.lit(1)).cast("int").alias("quantity_returned"),
        F.concat(F.lit("line status "), F.col("l_linestatus")).alias("reason"),
        *carry,
    )


def costs(spark: SparkSession, sf_dir: str, orders_df: DataFrame | None = None,
          products_df: DataFrame | None = None, months: DataFrame | None = None) -> DataFrame:
    """One cost row per (product, month with sales); actual swings ±8 % around standard.

    ``months``: a row per product and ``cost_month`` with sales where that is at hand; its other columns stay.
    """
    if months is None:
        o = orders_df if orders_df is not None else orders(spark, sf_dir)
        months = o.select("product_id", F.trunc("order_date", "month").alias("cost_month")).distinct()
    p = products_df if products_df is not None else products(spark, sf_dir)
    pm = months.where(F.col("product_id").isNotNull() & F.col("cost_month").isNotNull())
    pm = pm.join(p.select("product_id", "unit_cost_standard"), "product_id", "left")
    m = F.year("cost_month") * 12 + F.month("cost_month")
    swing = 100 + (F.col("product_id") * 31 + m) % COST_SWING_MOD - COST_SWING_OFFSET
    std_c = F.round(F.col("unit_cost_standard") * 100, 0).cast("bigint")
    return pm.select(
        F.concat(F.lit("C-"), F.col("product_id").cast("string"), F.lit("-"),
                 F.date_format("cost_month", "yyyyMM")).alias("cost_id"),
        "product_id",
        "cost_month",
        F.col("unit_cost_standard").alias("standard_cost"),
        from_cents(div_round(std_c * swing, F.lit(100))).cast("decimal(14,2)").alias("actual_cost"),
        *[c for c in months.columns if c not in ("product_id", "cost_month")],
    )


def mrr_events(spark: SparkSession, sf_dir: str, as_of: dt.date,
               orders_df: DataFrame | None = None) -> DataFrame:
    """Recurring-revenue events derived from each customer's monthly spend (E2).

    An event's product is the one the customer spent most on in the month that
    the event stems from (the smaller id of equal ones).
    """
    o = orders_df if orders_df is not None else orders(spark, sf_dir)
    by_product = (o.groupBy("customer_id", F.trunc("order_date", "month").alias("month"), "product_id")
                  .agg(sum_money("net_amount").alias("spend")))
    monthly = by_product.groupBy("customer_id", "month").agg(
        sum_money("spend").alias("amount"),
        F.max_by("product_id", F.struct("spend", -F.col("product_id"))).alias("product_id"))
    ev = classify_mrr(monthly, keys=["customer_id"], as_of=as_of, carry=("product_id",))
    return ev.select(
        "event_id",
        "customer_id",
        "product_id",
        "event_month",
        "event_type",
        F.col("mrr_amount").cast("decimal(14,2)").alias("mrr_amount"),
    )


def product_mrr_events(orders_df: DataFrame, as_of: dt.date) -> DataFrame:
    """Recurring-revenue events of each customer and product (E2's own grain)."""
    monthly = (orders_df.where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
               .groupBy("customer_id", "product_id", F.trunc("order_date", "month").alias("month"))
               .agg(sum_money("net_amount").alias("amount")))
    return classify_mrr(monthly, keys=["customer_id", "product_id"], as_of=as_of)
