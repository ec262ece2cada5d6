"""Surrogate keys of the conformed dimensions (D3, D9): one append-only map per dimension and data folder.

Dimensions and facts read the same map, so a key means the same everywhere and stays as it is when members are added
(``operators.keymap``).  Members:

* team: regions of the orders side and teams of the board;
* person: the three sentinels, then the supplier roster;
* sprint: quarters of each team's orders, and the sprint calendar for each team of the board;
* status: the fixed statuses;
* label: canonical labels set or removed on the board, and the size labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcube.functions import text
from flowcube.operators import dims, keymap
from flowcube.plans import concentration as conc
from flowcube.plans import standins as si
from flowcube.sources import published
from flowcube.sources.tables import Tables

# Status -> (Portuguese name, ended, succeeded).
STATUSES = {"opened": ("aberto", False, False), "closed": ("fechado", True, False), "merged": ("mesclado", True, True)}
#: Sentinels by role of an unresolved person.
EXTERNAL, BOT, UNKNOWN = (p for p, _ in dims.SENTINELS)


def _teams(spark, t: Tables) -> DataFrame:
    return t.region.select(F.col("r_name").alias("team")).union(si.board_columns(spark).select("team").distinct())


def _people(spark, t: Tables) -> DataFrame:
    sent = spark.createDataFrame([(p, i) for i, (p, _) in enumerate(dims.SENTINELS)], "person_id string, person_order bigint")
    return sent.union(t.supplier.select(F.col("s_suppkey").cast("string"), F.col("s_suppkey") + len(dims.SENTINELS)))


def _sprints(spark, t: Tables) -> DataFrame:
    orders = t.orders.join(si.customer_team(t), F.col("o_custkey") == F.col("c_custkey")).select("team", si.order_sprint().alias("sprint"))
    board = si.board_columns(spark).select("team").distinct().withColumn(
        "sprint", F.explode(F.array(*[F.lit(s) for s, _, _ in si.SPRINT_CALENDAR])))
    return orders.filter("sprint is not null").distinct().union(board)


def _statuses(spark, t: Tables) -> DataFrame:
    return spark.createDataFrame([(s,) for s in STATUSES], "status string")


def _labels(spark, t: Tables) -> DataFrame:
    named = si.raw_card_events(t).filter("column is not null").select("team", "column").distinct()
    marks = named.join(si.board_columns(spark).select("team", "column"), ["team", "column"], "left_anti")
    sizes = spark.createDataFrame([(s,) for s in text.SIZE_ALIASES], "label string")
    return marks.select(text.canonical_label(F.col("column")).alias("label")).union(sizes).distinct()


#: Dimension: members, natural key, order of new members, tables the members come from.
DIMENSIONS = {
    "team": (_teams, ["team"], ["team"], ["region"]),
    "person": (_people, ["person_id"], ["person_order"], ["supplier"]),
    "sprint": (_sprints, ["team", "sprint"], ["team", "sprint"], ["orders", "customer", "nation", "region"]),
    "status": (_statuses, ["status"], ["status"], ["region"]),
    "label": (_labels, ["label"], ["label"], ["events"]),
}


def key_map(spark, t: Tables, name: str) -> DataFrame:
    """Natural key columns and ``<name>_sk`` of a dimension."""
    def build():
        members, natural, order, tables = DIMENSIONS[name]
        mark = published.fingerprint(spark, [f"{t.sf_dir.rstrip('/')}/{x}.parquet" for x in tables])
        return keymap.extend(members(spark, t), natural, order, published.root_of(spark, f"keys-{name}", t.sf_dir), mark)
    return t.memo(f"keys:{name}", build).withColumnRenamed("sk", f"{name}_sk")


def roster_id(number: F.Column) -> F.Column:
    """Roster id of a person known by number; every tenth number is of nobody known."""
    return F.when(number % 10 == 0, F.lit(UNKNOWN)).otherwise(number.cast("string"))


def with_people(df: DataFrame, row: list[str], roles: dict[str, F.Column], people: DataFrame) -> DataFrame:
    """``df`` with one key column per role: the roles of a row are exploded, meet the person dimension once and are folded back.

    ``roles`` maps an output column to a person id (NULL: nobody).  An id that the dimension lacks is external.  ``row`` is the key of ``df``.
    """
    outside = people.filter(F.col("person_id") == EXTERNAL).select("person_sk").scalar()
    if len(roles) == 1:  # nothing to fold
        [(role, person)] = roles.items()
        who = people.select(F.col("person_id").alias("__who"), F.col("person_sk").alias("__sk"))
        found = df.withColumn("__who", person).join(who, "__who", "left")
        return found.withColumn(role, F.when(F.col("__who").isNotNull(), F.coalesce("__sk", outside))).drop("__who", "__sk")
    listed = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.coalesce(p, F.lit(None).cast("string")).alias("person_id")) for r, p in roles.items()]))
    held = df.select(*row, listed.alias("x")).select(*row, "x.role", "x.person_id").filter("person_id is not null")
    found = held.join(people, "person_id", "left").withColumn("person_sk", F.coalesce("person_sk", outside))
    folded = found.groupBy(*row).agg(*[F.max(F.when(F.col("role") == r, F.col("person_sk"))).alias(r) for r in roles])
    return df.join(folded, row, "left")


#: Key maps in DuckDB, over the tables of COMMITS_SQL.
TEAM_KEYS_SQL = """tk_ AS (SELECT team, CAST(row_number() OVER (ORDER BY team) AS BIGINT) AS team_sk
  FROM (SELECT r_name AS team FROM region UNION ALL VALUES ('T0'), ('T1'), ('T2')))"""
SPRINT_KEYS_SQL = """quarters_ AS (SELECT DISTINCT c_.team, CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS sprint
  FROM orders JOIN (SELECT c_custkey, r_name AS team FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey) c_
    ON c_.c_custkey = o_custkey WHERE o_orderstatus <> 'O'),
sk_ AS (SELECT team, sprint, CAST(row_number() OVER (ORDER BY team, sprint) AS BIGINT) AS sprint_sk FROM (
  SELECT team, sprint FROM quarters_
  UNION ALL SELECT team, sprint FROM (VALUES ('T0'), ('T1'), ('T2')) a(team), (VALUES """ + ", ".join(
    f"('{s}')" for s, _, _ in si.SPRINT_CALENDAR) + """) b(sprint)))"""


def person_sql(person: str) -> str:
    """Key of a person id (text, NULL for nobody): sentinels, then the roster by number; others are external."""
    return (f"CAST(CASE WHEN {person} IS NULL THEN NULL WHEN {person} = '{UNKNOWN}' THEN 3 WHEN {person} = '{BOT}' THEN 2 "
            f"WHEN TRY_CAST({person} AS BIGINT) IN (SELECT s_suppkey FROM supplier) "
            f"THEN 3 + (SELECT count(*) FROM supplier x_ WHERE x_.s_suppkey <= TRY_CAST({person} AS BIGINT)) ELSE 1 END AS BIGINT)")


def roster_sql(number: str) -> str:
    return f"(CASE WHEN {number} % 10 = 0 THEN '{UNKNOWN}' ELSE CAST({number} AS VARCHAR) END)"


STATUS_SQL = "CAST(CASE {s} WHEN 'closed' THEN 1 WHEN 'merged' THEN 2 ELSE 3 END AS BIGINT)"
