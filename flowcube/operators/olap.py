"""Star-schema item fact, additive monthly mart and the report queries over them.

Canonical inputs (column names, any extra columns are ignored):

* ``items``      order_id, order_item_id, product_id, seller_id, price, freight_value
* ``orders``     order_id, customer_id, order_status, purchased_at
* ``customers``  customer_id, customer_unique_id, customer_city, customer_state
* ``products``   product_id, category_name
* ``translation`` category_name, category_name_english

Money is summed as DECIMAL(18,2) so totals reconcile exactly across layers;
ratios are computed once, in double, from those exact totals.

Scale notes: the only large shuffles are items ⋈ products, while items are
narrow, and items ⋈ orders on ``order_id``.  The customer and product sides
are joined by key and left to AQE, which turns them into broadcast joins only
when their runtime size is under the broadcast threshold.  Distinct-order counts are computed per group
(``count(DISTINCT)`` becomes a two-phase aggregate keyed by the group and the
order id, so no group has to fit in one task).  Every window that orders a
whole result runs on an already aggregated, bounded relation (categories,
states, months), never on the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.functions.timecalc import cents, year_month

# Fixed values that must equal the reference's output labels.
NO_CATEGORY = "(sem categoria)"
REST_LABEL = "outras"

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def money(col) -> F.Column:
    return F.col(col).cast(MONEY) if isinstance(col, str) else col.cast(MONEY)


def money_sum(col) -> F.Column:
    return F.sum(money(col)).cast(MONEY_SUM)


def ratio(num: F.Column, den: F.Column, scale: float | None = None) -> F.Column:
    """``scale * num / den`` in double, NULL when ``den`` is 0 or NULL."""
    n = num.cast("double")
    if scale is not None:
        n = F.lit(float(scale)) * n
    return F.try_divide(n, den.cast("double"))


FACT_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "customer_id", "customer_unique_id", "order_status",
                "purchased_at", "month", "customer_state", "customer_city", "category_original", "category_english",
                "category", "price", "freight_value"]


def item_fact(items: DataFrame, orders: DataFrame, customers: DataFrame,
              products: DataFrame, translation: DataFrame,
              default_category: str = NO_CATEGORY) -> DataFrame:
    """Fact at item grain (M23): many-to-one left joins, month, default category."""
    i = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    o = orders.select("order_id", "customer_id", "order_status", "purchased_at")
    c = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    p = products.select("product_id", F.col("category_name").alias("category_original"))
    t = translation.select(F.col("category_name").alias("category_original"),
                           F.col("category_name_english").alias("category_english"))
    # Orders are enriched with their customer and products with their translation (one row per category: a bounded
    # dimension) first: items are shuffled at most by product, while they are narrow, and by order, never by customer
    # or by the few categories.
    oc = o.join(c, "customer_id", "left")
    pt = p.join(F.broadcast(t), "category_original", "left")
    fact = i.join(pt, "product_id", "left").join(oc, "order_id", "left")
    return fact.withColumn("month", F.trunc("purchased_at", "month")).withColumn(
        "category", F.coalesce("category_original", F.lit(default_category))).select(*FACT_COLUMNS)


MART_COLUMNS = ["month", "customer_state", "category", "product_revenue", "freight", "items"]


def monthly_mart(fact: DataFrame) -> DataFrame:
    """Month × state × category with additive measures only."""
    return (fact.groupBy("month", "customer_state", "category")
                .agg(money_sum("price").alias("product_revenue"),
                     money_sum("freight_value").alias("freight"),
                     F.count(F.lit(1)).alias("items"))
                .select(*MART_COLUMNS))


def kpis(fact: DataFrame) -> DataFrame:
    """One KPI row (M25): revenue, freight, orders, ticket, items, first/last, statuses.

    The fact is first reduced to one row per order (an order has one status
    and one purchase instant), so the distinct counts need no Expand of the
    item rows and the final aggregate reads one row per order.
    """
    per_order = (fact.groupBy("order_id", "order_status", "purchased_at")
                     .agg(F.sum(money("price")).alias("rev"), F.sum(money("freight_value")).alias("frt"),
                          F.count(F.lit(1)).alias("n")))
    agg = per_order.agg(F.sum("rev").cast(MONEY_SUM).alias("revenue"),
                        F.sum("frt").cast(MONEY_SUM).alias("freight"),
                        F.count(F.lit(1)).alias("orders"),
                        F.sum("n").alias("items"),
                        F.min("purchased_at").alias("first_purchase"),
                        F.max("purchased_at").alias("last_purchase"),
                        F.countDistinct("order_status").alias("statuses"))
    return agg.select("revenue", "freight", "orders",
                      ratio(F.col("revenue"), F.col("orders")).alias("ticket"),
                      "items", "first_purchase", "last_purchase", "statuses")


def month_totals(fact: DataFrame) -> DataFrame:
    """Revenue, distinct orders and items per month, via one row per (month, order)."""
    per_order = (fact.groupBy("month", "order_id")
                     .agg(F.sum(money("price")).alias("rev"), F.count(F.lit(1)).alias("n")))
    return (per_order.groupBy("month")
                     .agg(F.sum("rev").cast(MONEY_SUM).alias("revenue"),
                          F.count(F.lit(1)).alias("orders"),
                          F.sum("n").alias("items")))


def monthly_series(fact: DataFrame, partial_share: float = 0.01) -> DataFrame:
    """Dense monthly calendar (M26): empty months stay with zeros and a NULL ticket.

    ``is_partial`` marks months with fewer orders than ``partial_share`` of the
    busiest month.  The calendar is generated from the (bounded) month range
    of the aggregated fact, so it never grows with the row count.
    """
    m = month_totals(fact)
    cal = (m.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
             .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month")))
    s = (cal.join(m, "month", "left")
            .select(F.date_format("month", "yyyy-MM").alias("month"),
                    F.coalesce("revenue", F.lit(0).cast(MONEY_SUM)).alias("revenue"),
                    F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"),
                    ratio(F.col("revenue"), F.col("orders")).alias("ticket"),
                    F.coalesce("items", F.lit(0).cast("bigint")).alias("items")))
    # One row per calendar month: the window over all months is bounded by the month span.
    peak = F.max("orders").over(Window.partitionBy())
    return s.withColumn("is_partial", F.col("orders") < F.lit(partial_share) * peak)


def category_totals(mart: DataFrame) -> DataFrame:
    return (mart.groupBy("category")
                .agg(F.sum("product_revenue").cast(MONEY_SUM).alias("revenue"),
                     F.sum("items").cast("bigint").alias("items")))


def pareto(mart: DataFrame, n: int = 10) -> DataFrame:
    """Top-n categories by revenue with share and cumulative coverage.

    Works on the mart aggregated to category grain, so the global ordering
    windows see one row per category.
    """
    cat = category_totals(mart)
    order = Window.orderBy(F.col("revenue").desc(), F.col("category").asc())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = (cat.withColumn("total", F.sum("revenue").over(whole))
            .withColumn("total_categories", F.count(F.lit(1)).over(whole))
            .withColumn("position", F.row_number().over(order))
            .withColumn("running", F.sum("revenue").over(running)))
    return (r.filter(F.col("position") <= n)
             .select("position", "category", "revenue", "items",
                     ratio(F.col("revenue"), F.col("total"), 100).alias("pct"),
                     ratio(F.col("running"), F.col("total"), 100).alias("cumulative_pct"),
                     "total_categories"))


def top_category_ticket(fact: DataFrame, top: DataFrame) -> DataFrame:
    """Distinct orders and ticket of the selected categories (M28), via a semi join."""
    f = fact.join(top.select("category"), "category", "left_semi")
    g = f.groupBy("category").agg(F.countDistinct("order_id").alias("orders"),
                                  money_sum("price").alias("revenue"))
    return g.select("category", "orders", ratio(F.col("revenue"), F.col("orders")).alias("ticket"))


def topn_with_rest(mart: DataFrame, fact: DataFrame, top: DataFrame) -> DataFrame:
    """The tail outside the top categories (M29): categories, revenue, items, orders."""
    m = (mart.join(top.select("category"), "category", "left_anti")
             .agg(F.countDistinct("category").alias("categories"),
                  F.coalesce(F.sum("product_revenue"), F.lit(0)).cast(MONEY_SUM).alias("revenue"),
                  F.coalesce(F.sum("items"), F.lit(0)).cast("bigint").alias("items")))
    orders = (fact.join(top.select("category"), "category", "left_anti")
                  .agg(F.countDistinct("order_id"))).scalar()
    return m.select("categories", "revenue", "items", orders.alias("orders"))


def state_summary(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Revenue and freight from the mart, distinct orders from the fact."""
    m = (mart.groupBy("customer_state")
             .agg(F.sum("product_revenue").cast(MONEY_SUM).alias("revenue"),
                  F.sum("freight").cast(MONEY_SUM).alias("freight")))
    f = fact.groupBy("customer_state").agg(F.countDistinct("order_id").alias("orders"))
    j = m.join(f, "customer_state")
    # One row per state: the window over all states is bounded by the state count.
    total = F.sum("revenue").over(Window.partitionBy())
    return j.select("customer_state", "revenue", "orders",
                    ratio(F.col("revenue"), F.col("orders")).alias("ticket"),
                    "freight", ratio(F.col("revenue"), total, 100).alias("pct"))


def status_share(orders: DataFrame) -> DataFrame:
    """Orders by status with their share of all orders (M31, window over the aggregate)."""
    g = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    total = F.sum("orders").over(Window.partitionBy())  # one row per status
    return g.select("order_status", "orders", ratio(F.col("orders"), total, 100).alias("pct"))


def status_items(fact: DataFrame) -> DataFrame:
    """Items, distinct orders and revenue per order status (M31, fact side)."""
    return (fact.groupBy("order_status")
                .agg(F.count(F.lit(1)).alias("items"),
                     F.countDistinct("order_id").alias("orders"),
                     money_sum("price").alias("revenue")))


def latest_orders(orders: DataFrame, customers: DataFrame, n: int = 5, check_customers: bool = False) -> DataFrame:
    """The n most recent orders with the customer's city and state (M32, top-k).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top n, so only n rows per partition reach the final merge.  Only these meet the customers; with
    ``check_customers`` orders without a customer are left out first (the orphan gate proves there are none).
    """
    newest = (orders.select("order_id", "order_status", "purchased_at", "customer_id")
                    .join(customers.select("customer_id"), "customer_id", "left_semi") if check_customers else
              orders.select("order_id", "order_status", "purchased_at", "customer_id"))
    top = newest.orderBy(F.col("purchased_at").desc(), F.col("order_id").asc()).limit(n)
    # n rows meet the customers, so the big side is only filtered
    return (F.broadcast(top).join(customers.select("customer_id", "customer_city", "customer_state"), "customer_id")
             .select("order_id", "order_status", "purchased_at", "customer_city", "customer_state"))


def monthly_cents(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The comparison query (M33): revenue in integer cents, distinct orders, items per month.

    Items are reduced to one row per order before the join (map-side partial
    aggregation, then one shuffle by order id); the join output is already one
    row per order, so distinct orders per month is a plain count and the last
    aggregate runs over months only.
    """
    per_order = (items.groupBy("order_id")
                      .agg(F.sum(cents("price")).alias("cents"),
                           F.count(F.lit(1)).alias("n")))
    o = orders.select("order_id", year_month("purchased_at").alias("month"))
    return (per_order.join(o, "order_id")
                     .groupBy("month")
                     .agg(F.sum("cents").alias("revenue_cents"),
                          F.count(F.lit(1)).alias("orders"),
                          F.sum("n").alias("items")))


def untranslated(fact: DataFrame, default_category: str = NO_CATEGORY) -> DataFrame:
    """Categories without translation, plus the default-category bucket."""
    no_tr = fact.filter(F.col("category_original").isNotNull() & F.col("category_english").isNull())
    no_cat = fact.filter(F.col("category") == F.lit(default_category))
    a = no_tr.groupBy("category").agg(F.count(F.lit(1)).alias("items")).withColumn("kind", F.lit("untranslated"))
    b = no_cat.groupBy("category").agg(F.count(F.lit(1)).alias("items")).withColumn("kind", F.lit("no_category"))
    return a.unionByName(b).select("kind", "category", "items")


def non_additivity(fact: DataFrame) -> DataFrame:
    """Distinct orders are not additive over categories.

    Returns the true total, the sum of per-category distinct counts and the
    number of orders spanning several categories.
    """
    per_order = (fact.select("order_id", "category").distinct()
                     .groupBy("order_id").agg(F.count(F.lit(1)).alias("k")))
    return per_order.agg(F.count(F.lit(1)).alias("orders_total"),
                         F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("orders_summed_by_category"),
                         F.count_if(F.col("k") > 1).alias("multi_category_orders"))
