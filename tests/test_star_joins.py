import re

from flowcube.operators import olap, quality

ITEM = "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, price double, freight_value double"


def test_items_meet_products_and_orders_and_never_the_categories(spark):
    row = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    items = row(ITEM, (1, 1, 1, 1, 2.0, 1.0), (1, 2, 2, 1, 3.0, 1.0), (2, 1, 3, 1, 4.0, 1.0), (None, 1, None, 1, 5.0, 1.0))
    orders = row("order_id bigint, customer_id bigint, order_status string, purchased_at timestamp_ntz", (1, 1, "F", None), (2, None, "F", None))
    customers = row("customer_id bigint, customer_unique_id string, customer_city string, customer_state string", (1, "a", "c", "s"))
    products = row("product_id bigint, category_name string", (1, "x"), (2, "y"), (3, None))
    translation = row("category_name string, category_name_english string", ("x", "ex"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = olap.item_fact(items, orders, customers, products, translation)
        plan = f._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"SortMergeJoin \[(\w+)#", plan) == ["order_id", "product_id", "customer_id"]
        got = {(r.order_id, r.order_item_id): (r.category, r.category_english, r.customer_state) for r in f.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {(1, 1): ("x", "ex", "s"), (1, 2): ("y", None, "s"), (2, 1): (olap.NO_CATEGORY, None, None),
                   (None, 1): (olap.NO_CATEGORY, None, None)}


def test_size_of_a_left_join_counts_rows_without_a_match_and_matches_twice(spark):
    left = spark.createDataFrame([(1, 2.0), (1, 3.5), (2, 1.0), (None, 4.0), (None, None)], "k bigint, x double")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "k bigint, y string")
    for r in (right, right.filter("y <> 'b'"), right.limit(0)):
        join = left.join(r, "k", "left").selectExpr("count(*)", "cast(sum(cast(x as decimal(18,2))) as decimal(38,2))").first()
        assert tuple(quality.left_join_size(left, r, "k", "x").first()) == tuple(join)
