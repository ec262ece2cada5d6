"""Quality gates and raw-input audits (§2.13, S3, S9, S17, S18) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowcube.functions.scalars import side_by_side
from flowcube.operators import olap, quality
from flowcube.plans import olap as olap_plan
from flowcube.sources import io
from flowcube.sources.tables import TABLES, Tables


def q_table_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return io.table_counts({name: getattr(t, name) for name in TABLES})


def q_grain_uniqueness(spark, sf_dir):
    t = Tables(spark, sf_dir)
    f, m = olap_plan.star(spark, sf_dir)
    parts = [
        quality.key_uniqueness(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.key_uniqueness(t.orders, "orders", ["o_orderkey"]),
        quality.key_uniqueness(t.customer, "customer", ["c_custkey"]),
        quality.key_uniqueness(t.part, "part", ["p_partkey"]),
        quality.key_uniqueness(t.events, "events", ["event_id"]),
        quality.key_uniqueness(f, "fact_item", ["order_id", "order_item_id"]),
        quality.key_uniqueness(m, "mart_monthly", ["month", "customer_state", "category"]),
    ]
    return quality.union_all(parts)


def q_orphans(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = quality.orphan_count
    return quality.union_all([
        o(t.lineitem, t.orders, "lineitem.l_orderkey -> orders", ["l_orderkey"], ["o_orderkey"]),
        o(t.lineitem, t.part, "lineitem.l_partkey -> part", ["l_partkey"], ["p_partkey"]),
        o(t.lineitem, t.supplier, "lineitem.l_suppkey -> supplier", ["l_suppkey"], ["s_suppkey"]),
        o(t.orders, t.customer, "orders.o_custkey -> customer", ["o_custkey"], ["c_custkey"]),
        o(t.customer, t.nation, "customer.c_nationkey -> nation", ["c_nationkey"], ["n_nationkey"]),
        o(t.supplier, t.nation, "supplier.s_nationkey -> nation", ["s_nationkey"], ["n_nationkey"]),
        o(t.nation, t.region, "nation.n_regionkey -> region", ["n_regionkey"], ["r_regionkey"]),
        o(t.labels, t.documents, "labels.doc_id -> documents", ["doc_id"], ["doc_id"]),
        o(t.events, t.customer, "events.user_id -> customer", ["user_id"], ["c_custkey"]),
    ])


def payments(t: Tables):
    """Payments stand-in: events keyed by the customer (user_id = o_custkey)."""
    return t.events.select(F.col("user_id").alias("customer_id"), "value")


def q_fanout_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    f = olap_plan.star(spark, sf_dir)[0]
    base = f.agg(F.count(F.lit(1)).alias("fact_rows"), olap.money_sum("price").alias("fact_revenue"))
    direct = quality.fanout(f, payments(t), "customer_id", "price").select(
        F.col("join_rows").alias("direct_join_rows"), F.col("join_measure").alias("direct_join_revenue"))
    pay = payments(t).groupBy("customer_id").agg(F.sum("value").alias("paid"), F.count(F.lit(1)).alias("n_pay"))
    pre = quality.left_join_size(f, pay, "customer_id", "price").select(
        F.col("join_rows").alias("preagg_join_rows"), F.col("join_measure").alias("preagg_join_revenue"))
    return (side_by_side(base, direct, pre)
                .withColumn("keeps_grain", F.col("preagg_join_rows") == F.col("fact_rows"))
                .withColumn("keeps_revenue", F.col("preagg_join_revenue") == F.col("fact_revenue")))


def q_fact_null_gates(spark, sf_dir):
    f = olap_plan.star(spark, sf_dir)[0]
    one = f.agg(F.count_if(F.col("customer_id").isNull()).alias("no_order"),
                F.count_if(F.col("customer_state").isNull()).alias("no_state"),
                F.count_if(F.col("category").isNull()).alias("no_category"),
                F.count_if(F.col("month").isNull()).alias("no_month"),
                F.lit(0).alias("zero"))
    return quality.gate_rows(one, [("items_without_order", "no_order", "zero"),
                                   ("items_without_state", "no_state", "zero"),
                                   ("items_with_null_category", "no_category", "zero"),
                                   ("items_without_month", "no_month", "zero")])


def q_reconciliation(spark, sf_dir):
    t = Tables(spark, sf_dir)
    i = olap_plan.items(t)
    f, m = olap_plan.star(spark, sf_dir)
    top = olap.pareto(m, 10)
    src = i.agg(olap.money_sum("price").alias("items_revenue"), olap.money_sum("freight_value").alias("items_freight"),
                F.count(F.lit(1)).alias("items_rows"), F.countDistinct("order_id").alias("items_orders"),
                F.count_if(F.round("price", 2) != F.col("price")).alias("price_gt_2dec"),
                F.count_if(F.round("freight_value", 2) != F.col("freight_value")).alias("freight_gt_2dec"),
                F.lit(0).alias("zero"))
    k = olap.kpis(f).select(F.col("revenue").alias("kpi_revenue"), F.col("freight").alias("kpi_freight"),
                            F.col("orders").alias("kpi_orders"), F.col("items").alias("kpi_items"))
    mt = m.agg(F.sum("product_revenue").cast(olap.MONEY_SUM).alias("mart_revenue"),
               F.sum("freight").cast(olap.MONEY_SUM).alias("mart_freight"),
               F.sum("items").cast("bigint").alias("mart_items"))
    st = olap.state_summary(m, f).agg(F.sum("revenue").cast(olap.MONEY_SUM).alias("state_revenue"),
                                      F.sum("orders").cast("bigint").alias("state_orders"))
    mo = olap.month_totals(f).agg(F.sum("revenue").cast(olap.MONEY_SUM).alias("month_revenue"),
                                  F.sum("orders").cast("bigint").alias("month_orders"))
    tp = top.agg(F.sum("revenue").alias("top_rev"))
    rest = olap.topn_with_rest(m, f, top).select(F.col("revenue").alias("rest_rev"))
    one = (side_by_side(src, k, mt, st, mo, tp, rest)
              .withColumn("top_plus_rest", (F.col("top_rev") + F.col("rest_rev")).cast(olap.MONEY_SUM)))
    return quality.gate_rows(one, [
        ("price_at_most_2_decimals", "price_gt_2dec", "zero"),
        ("freight_at_most_2_decimals", "freight_gt_2dec", "zero"),
        ("fact_rows_eq_items", "kpi_items", "items_rows"),
        ("fact_revenue_eq_items", "kpi_revenue", "items_revenue"),
        ("fact_freight_eq_items", "kpi_freight", "items_freight"),
        ("mart_revenue_eq_fact", "mart_revenue", "kpi_revenue"),
        ("mart_freight_eq_fact", "mart_freight", "kpi_freight"),
        ("mart_items_eq_fact", "mart_items", "kpi_items"),
        ("state_revenue_eq_kpi", "state_revenue", "kpi_revenue"),
        ("month_revenue_eq_kpi", "month_revenue", "kpi_revenue"),
        ("top_plus_rest_eq_kpi", "top_plus_rest", "kpi_revenue"),
        ("kpi_orders_eq_item_orders", "kpi_orders", "items_orders"),
        ("state_orders_eq_kpi", "state_orders", "kpi_orders"),
        ("month_orders_eq_kpi", "month_orders", "kpi_orders"),
    ])


def q_rule_checks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.rule_violations(j, {
        "ship_on_or_after_order": F.col("l_shipdate") >= F.col("o_orderdate"),
        "discount_in_range": F.col("l_discount").between(0, 0.1),
        "tax_in_range": F.col("l_tax").between(0, 0.08),
        "quantity_positive": F.col("l_quantity") > 0,
        "order_total_positive": F.col("o_totalprice") > 0,
        "status_known": F.col("o_orderstatus").isin("F", "O", "P"),
    })


def q_column_profile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.union_all([quality.column_profile(getattr(t, name), name) for name in TABLES])


def raw_events(t: Tables):
    """Raw text stand-in: event columns rendered as the text a CSV would hold."""
    e = t.events
    value_txt = F.col("value").cast("decimal(18,2)").cast("string")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        value_txt.alias("value"),
        F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(value_txt).alias("mixed"),
        F.col("ts").cast("date").cast("string").alias("day"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("instant"),
        F.col("event_type"),
        F.col("props"),
        F.regexp_replace("props", r"[^0-9]", "").alias("k"),
        F.lit(None).cast("string").alias("empty"),
    )


def q_type_inference(spark, sf_dir):
    return io.infer_types(raw_events(Tables(spark, sf_dir)))


def q_strict_cast_audit(spark, sf_dir):
    return io.strict_cast_audit(raw_events(Tables(spark, sf_dir)), {
        "event_id": "I", "value": "R", "k": "I", "day": "D", "props": "I", "event_type": "D", "mixed": "T"})


QUERIES = {
    "table_counts": q_table_counts,
    "grain_uniqueness": q_grain_uniqueness,
    "orphans": q_orphans,
    "fanout_audit": q_fanout_audit,
    "fact_null_gates": q_fact_null_gates,
    "reconciliation": q_reconciliation,
    "rule_checks": q_rule_checks,
    "column_profile": q_column_profile,
    "type_inference": q_type_inference,
    "strict_cast_audit": q_strict_cast_audit,
}

# ---------------------------------------------------------------- oracle SQL
_W = "WITH " + olap_plan.FACT_CTE


# Columns and types of the given tables, as Spark names the types.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _observed_sql(c: str, dtype: str) -> str:
    """Observed type of a column in DuckDB."""
    if dtype.startswith("array"):
        return f"CASE WHEN count({c}) = 0 THEN 'TEXT' ELSE 'ARRAY' END"
    if dtype in ("float", "double"):
        return f"CASE WHEN count({c}) = 0 THEN 'TEXT' WHEN bool_and({c} = floor({c})) THEN 'INTEGER' ELSE 'REAL' END"
    if dtype.startswith("timestamp"):
        return f"CASE WHEN count({c}) = 0 THEN 'TEXT' WHEN bool_and({c} = date_trunc('day', {c})) THEN 'DATE' ELSE 'DATETIME' END"
    if dtype == "string":
        every = lambda *patterns: "bool_and(" + " OR ".join(f"regexp_matches({c}, '{p}')" for p in patterns) + ")"
        return (f"CASE WHEN count({c}) = 0 THEN 'TEXT' WHEN {every(io.RE_INT)} THEN 'INTEGER' WHEN {every(io.RE_INT, io.RE_REAL)} THEN 'REAL' "
                f"WHEN {every(io.RE_DATE)} THEN 'DATE' WHEN {every(io.RE_DATE, io.RE_TIMESTAMP)} THEN 'DATETIME' ELSE 'TEXT' END")
    return f"CASE WHEN count({c}) = 0 THEN 'TEXT' ELSE 'INTEGER' END"


def _profile_sql():
    parts, n = [], quality.SHOWN
    for table in TABLES:
        for i, (c, dtype) in enumerate(x.split() for x in SCHEMAS[table].split(", ")):
            plain = not dtype.startswith("array")
            low, high = (f"substr(CAST(min({c}) AS VARCHAR), 1, {n})", f"substr(CAST(max({c}) AS VARCHAR), 1, {n})") if plain else ("NULL", "NULL")
            samples = f"""(SELECT string_agg(substr(CAST(v AS VARCHAR), 1, {n}), ' | ' ORDER BY r) FROM (
                SELECT {c} AS v, min(r) AS r FROM (SELECT {c}, row_number() OVER () AS r FROM {table}) WHERE {c} IS NOT NULL
                GROUP BY {c} ORDER BY 2 LIMIT {quality.SAMPLES}))""" if plain else "NULL"
            parts.append(f"""SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, '{dtype}' AS type_name,
                {_observed_sql(c, dtype)} AS observed_type,
                count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(DISTINCT {c}) AS distinct_values,
                {low} AS min_value, {high} AS max_value, {samples} AS samples FROM {table}""")
    return " UNION ALL ".join(parts)


RAW_EVENTS_SQL = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value,
         CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR)
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS mixed,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant,
         event_type, props,
         regexp_replace(props, '[^0-9]', '', 'g') AS k,
         CAST(NULL AS VARCHAR) AS empty
  FROM events)"""

_INFER_COLS = ["event_id", "value", "mixed", "day", "instant", "event_type", "props", "k", "empty"]


def _infer_sql():
    parts = []
    for i, c in enumerate(_INFER_COLS):
        v = f"nullif({c}, '')"
        parts.append(f"""SELECT {i} AS position, '{c}' AS column_name, count({v}) AS n,
          count(*) FILTER (WHERE regexp_matches({v}, '{io.RE_INT}')) AS i,
          count(*) FILTER (WHERE regexp_matches({v}, '{io.RE_INT}') OR regexp_matches({v}, '{io.RE_REAL}')) AS r,
          count(*) FILTER (WHERE regexp_matches({v}, '{io.RE_DATE}')) AS d,
          count(*) FILTER (WHERE regexp_matches({v}, '{io.RE_TIMESTAMP}')) AS t
          FROM raw""")
    return ("WITH " + RAW_EVENTS_SQL + ", s AS (" + " UNION ALL ".join(parts) + """)
      SELECT position, column_name, n AS non_empty,
             CASE WHEN n = 0 THEN 'TEXT' WHEN i = n THEN 'INTEGER' WHEN r = n THEN 'REAL'
                  WHEN d = n THEN 'DATE' WHEN t = n THEN 'DATETIME' ELSE 'TEXT' END AS inferred_type
      FROM s""")


_STRICT = [("event_id", "I", "BIGINT"), ("value", "R", "DOUBLE"), ("k", "I", "BIGINT"), ("day", "D", "TIMESTAMP"),
           ("props", "I", "BIGINT"), ("event_type", "D", "TIMESTAMP"), ("mixed", "T", "VARCHAR")]


def _strict_sql():
    parts = [f"""SELECT '{c}' AS column_name, '{r}' AS rule, count({c}) AS non_null,
                 count({c}) - count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {ty}) IS NULL) AS converted,
                 count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {ty}) IS NULL) AS failed FROM raw"""
             for c, r, ty in _STRICT]
    return "WITH " + RAW_EVENTS_SQL + " " + " UNION ALL ".join(parts)


def _gates_sql(with_sql, specs):
    rows = " UNION ALL ".join(
        f"SELECT '{g}' AS gate, CAST({o} AS VARCHAR) AS observed, CAST({e} AS VARCHAR) AS expected FROM one"
        for g, o, e in specs)
    return f"{with_sql} SELECT gate, observed, expected, observed IS NOT DISTINCT FROM expected AS ok FROM ({rows})"


ORACLE = {
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) AS expected, true AS ok FROM {t}" for t in TABLES),
    "grain_uniqueness": _W + """
        SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS key_columns, count(*) AS rows,
               count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys FROM lineitem
        UNION ALL SELECT 'orders', 'o_orderkey', count(*), count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'customer', 'c_custkey', count(*), count(DISTINCT c_custkey) FROM customer
        UNION ALL SELECT 'part', 'p_partkey', count(*), count(DISTINCT p_partkey) FROM part
        UNION ALL SELECT 'events', 'event_id', count(*), count(DISTINCT event_id) FROM events
        UNION ALL SELECT 'fact_item', 'order_id,order_item_id', count(*), count(DISTINCT (order_id, order_item_id)) FROM fact
        UNION ALL SELECT 'mart_monthly', 'month,customer_state,category', count(*),
                         count(DISTINCT (month, customer_state, category)) FROM mart""".replace(
        "SELECT 'lineitem'", "SELECT *, rows = distinct_keys AS is_unique FROM (SELECT 'lineitem'") + ")",
    "orphans": " UNION ALL ".join(
        f"SELECT '{name}' AS relation, count(*) AS orphan_rows FROM {c} WHERE {ck} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{pk} = {c}.{ck})"
        for name, c, ck, p, pk in [
            ("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem.l_partkey -> part", "lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem.l_suppkey -> supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey"),
            ("customer.c_nationkey -> nation", "customer", "c_nationkey", "nation", "n_nationkey"),
            ("supplier.s_nationkey -> nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation.n_regionkey -> region", "nation", "n_regionkey", "region", "r_regionkey"),
            ("labels.doc_id -> documents", "labels", "doc_id", "documents", "doc_id"),
            ("events.user_id -> customer", "events", "user_id", "customer", "c_custkey"),
        ]),
    "fanout_audit": _W + """
        , base AS (SELECT count(*) AS fact_rows, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS fact_revenue FROM fact),
        direct AS (SELECT CAST(count(*) AS BIGINT) AS direct_join_rows,
                          CAST(sum(CAST(f.price AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS direct_join_revenue
                   FROM fact f JOIN events e ON e.user_id = f.customer_id),
        pay AS (SELECT user_id AS customer_id, sum(value) AS paid, count(*) AS n_pay FROM events GROUP BY user_id),
        pre AS (SELECT count(*) AS preagg_join_rows,
                       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS preagg_join_revenue
                FROM fact LEFT JOIN pay USING (customer_id))
        SELECT *, preagg_join_rows = fact_rows AS keeps_grain, preagg_join_revenue = fact_revenue AS keeps_revenue
        FROM base, direct, pre""",
    "fact_null_gates": _gates_sql(_W + """, one AS (SELECT
            count(*) FILTER (WHERE customer_id IS NULL) AS no_order,
            count(*) FILTER (WHERE customer_state IS NULL) AS no_state,
            count(*) FILTER (WHERE category IS NULL) AS no_category,
            count(*) FILTER (WHERE month IS NULL) AS no_month, 0 AS zero FROM fact)""",
        [("items_without_order", "no_order", "zero"), ("items_without_state", "no_state", "zero"),
         ("items_with_null_category", "no_category", "zero"), ("items_without_month", "no_month", "zero")]),
    "reconciliation": _gates_sql(_W + """,
        src AS (SELECT CAST(sum(CAST(price AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS items_revenue,
                       CAST(sum(CAST(freight_value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS items_freight,
                       count(*) AS items_rows, count(DISTINCT order_id) AS items_orders,
                       count(*) FILTER (WHERE round(price, 2) <> price) AS price_gt_2dec,
                       count(*) FILTER (WHERE round(freight_value, 2) <> freight_value) AS freight_gt_2dec,
                       0 AS zero FROM items_),
        k AS (SELECT CAST(sum(CAST(price AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS kpi_revenue,
                     CAST(sum(CAST(freight_value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS kpi_freight,
                     count(DISTINCT order_id) AS kpi_orders, count(*) AS kpi_items FROM fact),
        mt AS (SELECT CAST(sum(product_revenue) AS DECIMAL(38,2)) AS mart_revenue,
                      CAST(sum(freight) AS DECIMAL(38,2)) AS mart_freight, CAST(sum(items) AS BIGINT) AS mart_items FROM mart),
        st AS (SELECT CAST(sum(revenue) AS DECIMAL(38,2)) AS state_revenue, CAST(sum(orders) AS BIGINT) AS state_orders
               FROM (SELECT m.revenue, f.orders
                     FROM (SELECT customer_state, sum(product_revenue) AS revenue FROM mart GROUP BY 1) m
                     JOIN (SELECT customer_state, count(DISTINCT order_id) AS orders FROM fact GROUP BY 1) f
                     USING (customer_state))),
        mo AS (SELECT CAST(sum(revenue) AS DECIMAL(38,2)) AS month_revenue, CAST(sum(orders) AS BIGINT) AS month_orders
               FROM (SELECT month, sum(CAST(price AS DECIMAL(18,2))) AS revenue, count(DISTINCT order_id) AS orders
                     FROM fact GROUP BY month)),
        tp AS (SELECT sum(revenue) AS top_rev FROM pareto),
        rest AS (SELECT coalesce(sum(product_revenue), 0) AS rest_rev FROM mart
                 WHERE category NOT IN (SELECT category FROM pareto)),
        one AS (SELECT *, CAST(top_rev + rest_rev AS DECIMAL(38,2)) AS top_plus_rest
                FROM src, k, mt, st, mo, tp, rest)""", [
        ("price_at_most_2_decimals", "price_gt_2dec", "zero"),
        ("freight_at_most_2_decimals", "freight_gt_2dec", "zero"),
        ("fact_rows_eq_items", "kpi_items", "items_rows"),
        ("fact_revenue_eq_items", "kpi_revenue", "items_revenue"),
        ("fact_freight_eq_items", "kpi_freight", "items_freight"),
        ("mart_revenue_eq_fact", "mart_revenue", "kpi_revenue"),
        ("mart_freight_eq_fact", "mart_freight", "kpi_freight"),
        ("mart_items_eq_fact", "mart_items", "kpi_items"),
        ("state_revenue_eq_kpi", "state_revenue", "kpi_revenue"),
        ("month_revenue_eq_kpi", "month_revenue", "kpi_revenue"),
        ("top_plus_rest_eq_kpi", "top_plus_rest", "kpi_revenue"),
        ("kpi_orders_eq_item_orders", "kpi_orders", "items_orders"),
        ("state_orders_eq_kpi", "state_orders", "kpi_orders"),
        ("month_orders_eq_kpi", "month_orders", "kpi_orders")]),
    "rule_checks": """
        WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        one AS (SELECT count(*) FILTER (WHERE NOT coalesce(l_shipdate >= o_orderdate, false)) AS a,
                       count(*) FILTER (WHERE NOT coalesce(l_discount BETWEEN 0 AND 0.1, false)) AS b,
                       count(*) FILTER (WHERE NOT coalesce(l_tax BETWEEN 0 AND 0.08, false)) AS c,
                       count(*) FILTER (WHERE NOT coalesce(l_quantity > 0, false)) AS d,
                       count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) AS e,
                       count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) AS f FROM j)
        SELECT rule, violations, violations = 0 AS ok FROM (
          SELECT 'ship_on_or_after_order' AS rule, a AS violations FROM one UNION ALL
          SELECT 'discount_in_range', b FROM one UNION ALL SELECT 'tax_in_range', c FROM one UNION ALL
          SELECT 'quantity_positive', d FROM one UNION ALL SELECT 'order_total_positive', e FROM one UNION ALL
          SELECT 'status_known', f FROM one)""",
    "column_profile": _profile_sql(),
    "type_inference": _infer_sql(),
    "strict_cast_audit": _strict_sql(),
}
