"""Telemetry stand-ins derived from the driver's tables.

The reference's telemetry (teams, commits, cards, board events) is not part of
the driver data, so each canonical table is derived from a driver table with a
fixed formula.  The oracle SQL uses the very same formulas (``*_SQL`` CTEs
below), so Spark and DuckDB see identical inputs.

Orders side (team = region of the ordering customer):

* teams: one per region, created 1995-07-01 (earlier records are inherited).
* commits: one per order; merge = status 'P'; author = customer.
* cards: one per order; closed at the first shipment on/after the order date
  (open otherwise); size from the order priority; sprint = calendar quarter.

Events side (team = user_id % 3, card = user_id):

* board column = event_type among signup/view/click/purchase (positions 0..3);
  ``error`` is a label; NULL column when event_id % 97 = 0.
* action add/remove by event_id parity; card closed at the user's last
  purchase, open when user_id % 5 = 0; sprint 'Sprint 0n' by user, none when
  user_id % 7 = 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcube.sources.tables import Tables

TEAM_CREATED = "1995-07-01"
SILENCE_MARKER = "2001-03-31"


def customer_team(t: Tables) -> DataFrame:
    """customer -> team (region name); nation and region are tiny, bounded dimensions."""
    geo = F.broadcast(t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
                      .select("n_nationkey", F.col("r_name").alias("team")))
    return t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "team")


def teams(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_name").alias("team"),
                           F.lit(TEAM_CREATED).cast("timestamp_ntz").alias("created_at"))


#: Columns of an order that commits and cards are made of.
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def orders_with_team(t: Tables) -> DataFrame:
    """Orders with the team of their customer; a report that reads them many times reads written ones (``write_orders_with_team``)."""
    return t.memo("orders_with_team", lambda: t.orders.join(customer_team(t), F.col("o_custkey") == F.col("c_custkey")))


def write_orders_with_team(t: Tables) -> None:
    """Take commits and cards from the orders and closings that the contribution layer has written: neither orders and customers
    nor lines and orders meet again in a report."""
    from flowcube.plans import concentration
    t.replace("orders_with_team", concentration.placed_orders(t))


def commits(t: Tables) -> DataFrame:
    o = orders_with_team(t)
    added = F.floor(F.col("o_totalprice") / 100).cast("bigint")
    removed = F.col("o_custkey") % 50
    return o.select(
        "team", F.col("o_orderkey").alias("commit_id"), F.col("o_custkey").alias("author_id"),
        F.col("o_orderdate").alias("authored_at"), F.col("o_orderdate").alias("committed_at"),
        (F.col("o_orderstatus") == "P").alias("is_merge"),
        added.alias("lines_added"), removed.alias("lines_removed"), (added + removed).alias("lines_total"),
        commit_title().alias("title"), commit_message().alias("message"))


def commit_title() -> F.Column:
    """Every fourth title cites nothing valid ('#0d', '#Nx'); the others cite the card
    numbered like the author ('#N)') plus an invalid '#0d'."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return (F.when(k % 4 == 0, F.concat(F.lit("refactor #0"), (c % 10).cast("string"), F.lit(" #"),
                                         c.cast("string"), F.lit("x")))
             .otherwise(F.concat(F.lit("fix #"), c.cast("string"), F.lit(") and #0"), (k % 10).cast("string"))))


def commit_message() -> F.Column:
    """Cites the neighbouring card numbers."""
    k = F.col("o_orderkey")
    return F.concat(F.lit("see #"), (k - 1).cast("string"), F.lit(" #"), (k + 1).cast("string"))


def card_closes(t: Tables) -> DataFrame:
    """First shipment on/after the order date, per order (aggregated before any join)."""
    li = t.lineitem.select("l_orderkey", "l_shipdate")
    od = t.orders.select("o_orderkey", "o_orderdate")
    return (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
              .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
              .groupBy("o_orderkey").agg(F.min("l_shipdate").alias("closed_at")))


def cards(t: Tables) -> DataFrame:
    o = orders_with_team(t)
    c = o if "closed_at" in o.columns else o.join(card_closes(t), "o_orderkey", "left")
    return c.select(
        "team", F.col("o_orderkey").alias("card"), F.col("o_custkey").alias("author_id"),
        F.col("o_orderdate").alias("created_at"), "closed_at",
        F.when(F.col("closed_at").isNotNull(), "closed").otherwise("opened").alias("state"),
        F.col("o_orderpriority").alias("priority"),
        order_sprint().alias("sprint"))


def order_sprint() -> F.Column:
    """Calendar quarter of the order; open orders ('O') have no sprint."""
    return F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string")).otherwise(
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), F.quarter("o_orderdate").cast("string")))


COMMITS_SQL = """
teams_ AS (SELECT r_name AS team, TIMESTAMP '1995-07-01 00:00:00' AS created_at FROM region),
cust_team_ AS (SELECT c_custkey, r_name AS team FROM customer JOIN nation ON n_nationkey = c_nationkey
               JOIN region ON r_regionkey = n_regionkey),
commits_ AS (
  SELECT team, o_orderkey AS commit_id, o_custkey AS author_id, o_orderdate AS authored_at,
         o_orderdate AS committed_at, o_orderstatus = 'P' AS is_merge,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS lines_added, o_custkey % 50 AS lines_removed,
         CAST(floor(o_totalprice / 100) AS BIGINT) + o_custkey % 50 AS lines_total,
         CASE WHEN o_orderkey % 4 = 0
              THEN 'refactor #0' || CAST(o_custkey % 10 AS VARCHAR) || ' #' || CAST(o_custkey AS VARCHAR) || 'x'
              ELSE 'fix #' || CAST(o_custkey AS VARCHAR) || ') and #0' || CAST(o_orderkey % 10 AS VARCHAR) END AS title,
         'see #' || CAST(o_orderkey - 1 AS VARCHAR) || ' #' || CAST(o_orderkey + 1 AS VARCHAR) AS message
  FROM orders JOIN cust_team_ ON c_custkey = o_custkey),
closes_ AS (SELECT o_orderkey, min(l_shipdate) AS closed_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE l_shipdate >= o_orderdate GROUP BY o_orderkey),
cards_ AS (
  SELECT team, o.o_orderkey AS card, o_custkey AS author_id, o_orderdate AS created_at, closed_at,
         CASE WHEN closed_at IS NOT NULL THEN 'closed' ELSE 'opened' END AS state,
         o_orderpriority AS priority,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS sprint
  FROM orders o JOIN cust_team_ ON c_custkey = o_custkey LEFT JOIN closes_ cl ON cl.o_orderkey = o.o_orderkey)
"""


# ------------------------------------------------------------------ events side
# The board of every team (column name -> position).
BOARD = [("signup", 0), ("view", 1), ("click", 2), ("purchase", 3)]
BOARD_NAME = "Scrum Board"
# Sprint calendar of one team, re-applied to all teams (T20); weekends are gaps.
SPRINT_CALENDAR = [("Sprint 01", "2024-01-01", "2024-01-05"), ("Sprint 02", "2024-01-08", "2024-01-12"),
                   ("Sprint 03", "2024-01-15", "2024-01-19"), ("Sprint 04", "2024-01-22", "2024-01-26"),
                   ("Sprint 05", "2024-01-29", "2024-01-31")]
CALENDAR_TEAM = "T2"
# Sizes by order priority and planned days per size (orders-side cards).
PRIORITY_SIZE = [("1-URGENT", "SIZE_PP"), ("2-HIGH", "SIZE_P"), ("3-MEDIUM", "SIZE_M"), ("5-LOW", "SIZE_G")]
SIZE_DAYS = [("SIZE_PP", 0.25), ("SIZE_P", 0.5), ("SIZE_M", 1.0), ("SIZE_G", 3.0)]


def label_text() -> F.Column:
    """Raw label text of a labelling event (spellings that exercise canonicalisation)."""
    e = F.col("event_id")
    s = e % 23
    sizes = F.array(*[F.lit(x) for x in ["size pp", "Size_P", "m", "G", "gg"]])
    return (F.when(e % 8 == 0, F.concat(F.lit("Art. "), (s % 20).cast("string")))
             .when(e % 8 == 1, F.concat(F.lit("art."), F.lpad((s % 20).cast("string"), 2, "0")))
             .when(e % 8 == 2, F.element_at(sizes, (s % 5 + 1).cast("int")))
             .when(e % 8 == 3, F.concat(F.lit("P"), (s % 10).cast("string")))
             .when(e % 8 == 4, F.when(s % 2 == 0, F.lit("fix")).otherwise(F.lit("Bug")))
             .when(e % 8 == 5, F.when(s % 3 == 0, F.lit("negócios")).otherwise(F.lit("feature")))
             .when(e % 8 == 6, F.concat(F.lit("ano:"), (2020 + s % 3).cast("string")))
             .otherwise(F.lit(" error ")))


def raw_card_events(t: Tables) -> DataFrame:
    """Board event log with surrogate ids; rows with event_id % 50 = 1 are logged twice;
    the log id of row e is 2e and that of its copy 2e + 1, as an append-only log with duplicates."""
    e = t.events
    column = (F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
               .when(F.col("event_type") == "error", label_text())
               .otherwise(F.col("event_type")))
    person = (F.when(F.col("event_id") % 50 == 0, F.lit("ci-runner"))
               .otherwise(F.concat(F.lit("T"), (F.col("user_id") % 3).cast("string"), F.lit("-A"),
                                   (F.col("user_id") % 7).cast("string"))))
    base = e.select(
        (2 * F.col("event_id")).alias("event_id"), F.concat(F.lit("T"), (F.col("user_id") % 3).cast("string")).alias("team"),
        F.col("user_id").alias("card"),
        F.when(F.col("event_id") % 2 == 0, "add").otherwise("remove").alias("action"),
        column.alias("column"), person.alias("person"), F.col("ts").alias("occurred_at"))
    dup = base.filter(F.col("event_id") % 100 == 2).withColumn("event_id", F.col("event_id") + 1)
    return base.unionByName(dup)


def board_columns(spark) -> DataFrame:
    rows = [(f"T{i}", BOARD_NAME, pos, col) for i in range(3) for col, pos in BOARD]
    return spark.createDataFrame(rows, "team string, board string, position int, column string")


def sprint_calendar(spark) -> DataFrame:
    return spark.createDataFrame(SPRINT_CALENDAR, "sprint string, start_s string, end_s string").select(
        "sprint", F.col("start_s").cast("date").alias("start_date"), F.col("end_s").cast("date").alias("end_date"))


def board_cards(t: Tables) -> DataFrame:
    """Events-side cards: one per user; closed at the last purchase unless user_id % 5 = 0."""
    e = t.events
    per = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_buy"),
                                   F.min("ts").alias("first_ts"))
    return per.select(
        F.concat(F.lit("T"), (F.col("user_id") % 3).cast("string")).alias("team"),
        F.col("user_id").alias("card"), F.col("first_ts").alias("created_at"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("last_buy")).alias("closed_at"),
        F.when(F.col("user_id") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Sprint 0"), (1 + F.col("user_id") % 5).cast("string"))).alias("sprint"))


EVENTS_SQL = """
raw_events_ AS (
  SELECT 2 * event_id AS event_id, 'T' || CAST(user_id % 3 AS VARCHAR) AS team, user_id AS card,
         CASE WHEN events.event_id % 2 = 0 THEN 'add' ELSE 'remove' END AS action,
         CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_type = 'error' THEN (CASE
                 WHEN event_id % 8 = 0 THEN 'Art. ' || CAST(event_id % 23 % 20 AS VARCHAR)
                 WHEN event_id % 8 = 1 THEN 'art.' || lpad(CAST(event_id % 23 % 20 AS VARCHAR), 2, '0')
                 WHEN event_id % 8 = 2 THEN ['size pp', 'Size_P', 'm', 'G', 'gg'][CAST(event_id % 23 % 5 + 1 AS INTEGER)]
                 WHEN event_id % 8 = 3 THEN 'P' || CAST(event_id % 23 % 10 AS VARCHAR)
                 WHEN event_id % 8 = 4 THEN CASE WHEN event_id % 23 % 2 = 0 THEN 'fix' ELSE 'Bug' END
                 WHEN event_id % 8 = 5 THEN CASE WHEN event_id % 23 % 3 = 0 THEN 'negócios' ELSE 'feature' END
                 WHEN event_id % 8 = 6 THEN 'ano:' || CAST(2020 + event_id % 23 % 3 AS VARCHAR)
                 ELSE ' error ' END)
              ELSE event_type END AS "column",
         CASE WHEN event_id % 50 = 0 THEN 'ci-runner'
              ELSE 'T' || CAST(user_id % 3 AS VARCHAR) || '-A' || CAST(user_id % 7 AS VARCHAR) END AS person,
         ts AS occurred_at
  FROM events),
card_events_raw_ AS (SELECT * FROM raw_events_ UNION ALL
                     SELECT event_id + 1, team, card, action, "column", person, occurred_at
                     FROM raw_events_ WHERE event_id % 100 = 2),
board_ AS (SELECT * FROM (VALUES ('signup', 0), ('view', 1), ('click', 2), ('purchase', 3)) b("column", position)
           CROSS JOIN (VALUES ('T0'), ('T1'), ('T2')) t(team)),
sprint_cal_ AS (SELECT * FROM (VALUES ('Sprint 01', DATE '2024-01-01', DATE '2024-01-05'),
    ('Sprint 02', DATE '2024-01-08', DATE '2024-01-12'), ('Sprint 03', DATE '2024-01-15', DATE '2024-01-19'),
    ('Sprint 04', DATE '2024-01-22', DATE '2024-01-26'), ('Sprint 05', DATE '2024-01-29', DATE '2024-01-31'))
    s(sprint, start_date, end_date)),
board_cards_ AS (
  SELECT 'T' || CAST(user_id % 3 AS VARCHAR) AS team, user_id AS card, min(ts) AS created_at,
         CASE WHEN user_id % 5 = 0 THEN NULL ELSE max(CASE WHEN event_type = 'purchase' THEN ts END) END AS closed_at,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'Sprint 0' || CAST(1 + user_id % 5 AS VARCHAR) END AS sprint
  FROM events GROUP BY user_id)
"""
