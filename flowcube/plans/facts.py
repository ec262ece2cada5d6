"""Facts, small dimensions, subject views and their gates (D3, D5, D7, D8, D9; Q1, Q4, Q5, Q12, Q13).

Surrogate keys of team, person, sprint, status and label come from the dimensions' key maps (``plans.keys``).

Stand-ins, besides those of ``standins``: a merge request is an order (number = order key, author =
customer, closed with the card; merged when the order is 'F', by its author when custkey % 7 = 0 and else by
custkey + 1; no reviewer when custkey % 4 = 0; draft when orderkey % 20 = 0).  A commit is committed
orderkey % 7200 seconds after it was authored when orderkey % 25 = 0, else at once.  A card has a due day, a week
after its creation, when its number divides by 50.  Sprint dates are known for one team only.
A person known by number is the supplier of that number, of nobody known when the number divides by 10, and external
without such a supplier; board persons are unknown, or bots.  A card's title is its number; every third one has no description; it was updated with
its last shipment, is closed by custkey + 3, has orderkey % 9 comments, an estimate of orderkey % 8 hours when orderkey % 70 = 0, and the
board events of the card that has its author's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowcube.functions import text
from flowcube.functions.scalars import side_by_side
from flowcube.functions.timecalc import MICROS_PER_DAY, MICROS_PER_HOUR, elapsed_micros, rounded_ratio
from flowcube.operators import calendar as cal
from flowcube.operators import events as ev
from flowcube.operators import intervals as iv
from flowcube.operators import planning as pl
from flowcube.operators import quality
from flowcube.operators import recount
from flowcube.operators.materialize import materialize
from flowcube.plans import concentration as conc
from flowcube.plans import events as evp
from flowcube.plans import keys
from flowcube.plans import planning as plan
from flowcube.plans import standins as si
from flowcube.sources.tables import TABLES, Tables

DATED_TEAM = "EUROPE"
DUE_EVERY, DUE_DAYS = 50, 7
BRANCHES = ["main", "dev", "develop"]
COMMENTS_MOD, ESTIMATED_EVERY = 9, 70


def date_key(ts: str) -> F.Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def with_keys(df: DataFrame, spark, t: Tables, *names: str) -> DataFrame:
    """``df`` with the surrogate keys of the named dimensions (team, sprint, status) by its natural key columns; NULL without a member."""
    for name in names:
        df = df.join(keys.key_map(spark, t, name), keys.DIMENSIONS[name][1], "left")
    return df


def with_people(df: DataFrame, spark, t: Tables, row: str, **roles: F.Column) -> DataFrame:
    return keys.with_people(df, [row], roles, keys.key_map(spark, t, "person"))


def commits(t: Tables) -> DataFrame:
    late = F.when(F.col("commit_id") % 25 == 0, F.col("commit_id") % 7200).otherwise(0).cast("int")
    c = si.commits(t).withColumn("committed_at", F.col("authored_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), late))
    return c


def fact_commit(spark, t: Tables) -> DataFrame:
    """One row per commit, with template-history and third-party flags, net lines and authoring lag."""
    c = with_keys(commits(t).join(F.broadcast(si.teams(t)), "team"), spark, t, "team")
    c = with_people(c, spark, t, "commit_id", author_sk=keys.roster_id(F.col("author_id")))
    return c.select(
        "team_sk", "team", "commit_id", "author_sk", "author_id", date_key("authored_at").alias("authored_date_key"),
        F.hour("authored_at").alias("authored_hour_key"), date_key("committed_at").alias("committed_date_key"),
        F.hour("committed_at").alias("committed_hour_key"), "title", "is_merge",
        (F.col("committed_at") < F.col("created_at")).alias("is_template_history"),
        (F.col("authored_at") != F.col("committed_at")).alias("is_third_party"),
        "lines_added", "lines_removed", "lines_total", (F.col("lines_added") - F.col("lines_removed")).alias("lines_net"),
        (elapsed_micros("authored_at", "committed_at") / F.lit(1_000_000)).cast("bigint").alias("authoring_lag_s"))


def merge_requests(t: Tables) -> DataFrame:
    o = t.orders.join(si.customer_team(t), F.col("o_custkey") == F.col("c_custkey")).join(si.card_closes(t), "o_orderkey", "left")
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    ended = F.col("closed_at").isNotNull()
    merged = ended & (s == "F")
    return o.select(
        "team", k.alias("mr"), c.alias("author_id"), F.col("o_orderdate").alias("created_at"),
        F.when(merged, F.col("closed_at")).alias("merged_at"), F.when(ended & (s == "P"), F.col("closed_at")).alias("closed_at"),
        F.when(merged, F.when(c % 7 == 0, c).otherwise(c + 1)).alias("merged_by_id"),
        F.when(c % 4 != 0, c + 2).alias("reviewer_id"), (k % 20 == 0).alias("is_draft"),
        F.element_at(F.array(*[F.lit(b) for b in BRANCHES]), (k % 3 + 1).cast("int")).alias("target_branch"),
        F.when(merged, "merged").when(ended & (s == "P"), "closed").otherwise("opened").alias("status"),
        (c % 6).alias("comments"), si.order_sprint().alias("sprint"))


def fact_merge_request(spark, t: Tables) -> DataFrame:
    """One row per merge request, with self-merge, reviewer and time to merge."""
    m = with_keys(merge_requests(t), spark, t, "team", "sprint", "status")
    m = with_people(m, spark, t, "mr", author_sk=keys.roster_id(F.col("author_id")), merged_by_sk=keys.roster_id(F.col("merged_by_id")),
                    reviewer_sk=keys.roster_id(F.col("reviewer_id")))
    return m.select(
        "team_sk", "team", "mr", "author_sk", "merged_by_sk", "reviewer_sk", "sprint_sk", "status_sk",
        "author_id", "merged_by_id", "reviewer_id", "sprint", "status",
        date_key("created_at").alias("created_date_key"), F.hour("created_at").alias("created_hour_key"),
        date_key("merged_at").alias("merged_date_key"), date_key("closed_at").alias("closed_date_key"),
        "target_branch", (F.col("status") == "merged").alias("is_merged"), "is_draft",
        F.col("reviewer_id").isNotNull().alias("has_reviewer"),
        F.coalesce(F.col("author_id") == F.col("merged_by_id"), F.lit(False)).alias("is_self_merge"),
        (F.col("target_branch") == "main").alias("is_to_default_branch"),
        F.when(F.col("merged_at").isNotNull(), rounded_ratio(elapsed_micros("created_at", "merged_at"), MICROS_PER_HOUR, 2))
         .alias("hours_to_merge"), "comments", F.lit(1).alias("mr_counter"))


def fact_card(spark, t: Tables) -> DataFrame:
    """One row per card: milestones, roles, flags, lead time, labels, comments, estimate and board events."""
    c = plan.sized_cards(spark, t).select("team", "card", "author_id", "created_at", "closed_at", "sprint", "state", "size")
    axes = conc.axis_cards(spark, t).select("team", "card", "assignee", "labels")
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("card")).agg(F.max("l_shipdate").alias("shipped_at"))
    logged = ev.dedupe_events(si.raw_card_events(t)).groupBy(F.col("card").alias("author_id")).agg(F.count(F.lit(1)).alias("event_count"))
    c = c.join(axes, ["team", "card"], "left").join(shipped, "card", "left").join(logged, "author_id", "left")
    closed, k = F.col("closed_at").isNotNull(), F.col("card")
    c = c.withColumn("status", F.when(closed, "closed").otherwise("opened"))
    due = F.when(k % DUE_EVERY == 0, F.date_add(F.to_date("created_at"), DUE_DAYS))
    c = (c.withColumn("due", due).withColumn("micros", elapsed_micros("created_at", "closed_at"))
         .withColumn("updated_at", F.greatest("created_at", "shipped_at")).withColumn("label", F.concat(F.lit("SIZE_"), F.col("size"))))
    c = with_keys(c, spark, t, "team", "sprint", "status", "label")
    c = with_people(c, spark, t, "card", author_sk=keys.roster_id(F.col("author_id")), closed_by_sk=F.when(closed, keys.roster_id(F.col("author_id") + 3)),
                    assignee_sk=F.when(F.col("assignee") != "(vazio)", F.split("assignee", ";")[0]))
    return c.select(
        "team_sk", "team", "card", "author_sk", "assignee_sk", "closed_by_sk", "sprint_sk", "status_sk",
        F.col("label_sk").alias("size_sk"), "author_id", "sprint", "status", "size", F.concat(F.lit("card #"), k.cast("string")).alias("title"),
        date_key("created_at").alias("created_date_key"), F.hour("created_at").alias("created_hour_key"),
        date_key("closed_at").alias("closed_date_key"), date_key("due").alias("due_date_key"), date_key("updated_at").alias("updated_date_key"),
        closed.alias("is_closed"), F.col("due").isNotNull().alias("has_due"),
        F.when(F.col("due").isNotNull(), F.coalesce(F.to_date("closed_at") > F.col("due"), F.lit(True))).alias("is_overdue"),
        (k % 3 != 0).alias("has_description"),
        F.coalesce(F.col("assignee") != "(vazio)", F.lit(False)).alias("has_assignee"),
        F.when(closed, rounded_ratio(F.col("micros"), MICROS_PER_HOUR, 2)).alias("lead_time_hours"),
        F.when(closed, rounded_ratio(F.col("micros"), MICROS_PER_DAY, 2)).alias("lead_time_days"),
        (k % COMMENTS_MOD).alias("comments"),
        F.coalesce(F.size(F.split("labels", ";")), F.lit(0)).alias("label_count"),
        F.coalesce("event_count", F.lit(0)).cast("bigint").alias("event_count"),
        F.when(k % ESTIMATED_EVERY == 0, (k % 8) * 3600).otherwise(0).cast("bigint").alias("estimated_s"), F.lit(1).alias("card_counter"))


def board_columns(spark, t: Tables) -> DataFrame:
    """Board columns that the log has used, with their place in the flow (D3)."""
    used = ev.dedupe_events(si.raw_card_events(t)).select("team", "column").distinct()
    b = si.board_columns(spark).join(used, ["team", "column"])
    flow = Window.partitionBy("team", "board")
    return b.select(F.concat_ws("|", "team", "board", "column").alias("column_key"), "team", "board", "column", "position",
                    (F.col("position") == F.min("position").over(flow)).alias("is_first"),
                    (F.col("position") == F.max("position").over(flow)).alias("is_last"))


def fact_event(spark, t: Tables) -> DataFrame:
    """One row per distinct board event with its target: a board column, a label or nothing."""
    e = ev.event_treatment(si.raw_card_events(t), si.board_columns(spark), si.sprint_calendar(spark), si.CALENDAR_TEAM)
    cols = board_columns(spark, t).select("team", F.col("column").alias("board_column"), "column_key")
    e = with_keys(e.join(cols, ["team", "board_column"], "left").withColumn("label", F.col("canonical_label")), spark, t, "team", "sprint", "label")
    e = with_people(e, spark, t, "event_id", person_sk=F.when(F.col("is_bot") == 1, keys.BOT).otherwise(keys.UNKNOWN))
    return e.select("event_id", "team_sk", "team", "card", "person_sk", "person", "sprint_sk", "sprint", F.date_format("event_date", "yyyyMMdd").cast("int").alias("date_key"),
                    F.col("event_hour").alias("hour_key"), "column_key", "label_sk", F.col("canonical_label").alias("label_key"),
                    "label_category", "kind", "action", "is_bot", "seq_in_card", "hours_to_next", "event_counter")


def target_ok() -> F.Column:
    """An event has exactly the target its kind asks for."""
    col, label = F.col("column_key").isNotNull(), F.col("label_key").isNotNull()
    return (F.when(F.col("kind") == ev.KIND_MOVE, col & ~label).when(F.col("kind") == ev.KIND_LABEL, label & ~col)
             .when(F.col("kind") == ev.KIND_UNKNOWN, ~col & ~label).otherwise(F.lit(False)))


def sprints(t: Tables) -> DataFrame:
    """Quarters of each team's orders; dates informed for one team only."""
    o = t.orders.join(si.customer_team(t), F.col("o_custkey") == F.col("c_custkey")).withColumn("sprint", si.order_sprint())
    s = o.filter("sprint is not null").groupBy("team", "sprint").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    dated = F.col("team") == DATED_TEAM
    return s.select("team", "sprint", F.when(dated, F.col("a")).alias("starts_on"), F.when(dated, F.col("b")).alias("due_on"))


def q_dim_sprint(spark, sf_dir):
    """Sprints of the orders side by quarter, and the calendar's for the board teams; dates where they are informed."""
    t = Tables(spark, sf_dir)
    cal_ = si.sprint_calendar(spark).withColumn("team", F.explode(F.array(*[F.lit(x) for x in sorted({f"T{i}" for i in range(3)})])))
    informed = F.col("team") == si.CALENDAR_TEAM
    board = cal_.select("team", "sprint", F.when(informed, F.col("start_date")).alias("starts_on"), F.when(informed, F.col("end_date")).alias("due_on"))
    s = with_keys(sprints(t).unionByName(board), spark, t, "sprint")
    return s.select("sprint_sk", "team", "sprint", F.row_number().over(Window.partitionBy("team").orderBy("sprint")).alias("sprint_no"),
                    "starts_on", "due_on", F.datediff("due_on", "starts_on").alias("days"),
                    F.when(F.col("starts_on").isNotNull(), "INFORMADA").otherwise("AUSENTE").alias("date_origin"))


def q_dim_status(spark, sf_dir):
    """Statuses that cards and merge requests have taken (conformed)."""
    t = Tables(spark, sf_dir)
    seen = si.cards(t).select(F.col("state").alias("status")).union(merge_requests(t).select("status")).distinct()
    names = spark.createDataFrame([(k, *v) for k, v in keys.STATUSES.items()], "status string, name string, is_ended boolean, is_success boolean")
    return with_keys(seen.join(F.broadcast(names), "status", "left"), spark, t, "status").select(
        "status_sk", "status", "name", "is_ended", "is_success")


def q_dim_label(spark, sf_dir):
    """Labels of the board and the size labels, with their category (D3)."""
    return keys.key_map(spark, Tables(spark, sf_dir), "label").select("label_sk", "label", text.label_category(F.col("label")).alias("category"))


def q_dim_board_column(spark, sf_dir):
    return board_columns(spark, Tables(spark, sf_dir))


def q_fact_commit(spark, sf_dir):
    return fact_commit(spark, Tables(spark, sf_dir))


def q_fact_merge_request(spark, sf_dir):
    return fact_merge_request(spark, Tables(spark, sf_dir))


def q_fact_card(spark, sf_dir):
    return fact_card(spark, Tables(spark, sf_dir))


def q_fact_event(spark, sf_dir):
    return fact_event(spark, Tables(spark, sf_dir))


def q_authored_commits(spark, sf_dir):
    """Subject view: commits of the team itself, without the inherited history."""
    return fact_commit(spark, Tables(spark, sf_dir)).filter(~F.col("is_template_history"))


def q_board_moves(spark, sf_dir):
    """Subject view: events that move a card, with the column's place."""
    t = Tables(spark, sf_dir)
    cols = board_columns(spark, t).select("column_key", "column", "position")
    return fact_event(spark, t).filter(F.col("kind") == ev.KIND_MOVE).join(cols, "column_key").select(
        "event_id", "team", "card", "action", "column", "position", "date_key", "hour_key", "seq_in_card")


def q_label_marks(spark, sf_dir):
    """Subject view: events that set or remove a label."""
    return fact_event(spark, Tables(spark, sf_dir)).filter(F.col("kind") == ev.KIND_LABEL).select(
        "event_id", "team", "card", "action", "label_key", "label_category", "date_key", "hour_key")


def q_role_dates(spark, sf_dir):
    """Role-playing dates: cards per month as created, closed, due and updated, merge requests as merged."""
    t = Tables(spark, sf_dir)
    def dated(f, *roles):
        return f.select("team", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.expr(f"{r}_date_key div 100").cast("int").alias("month_key"))
                                                    for r in roles])).alias("r"))
    f = dated(fact_card(spark, t), "created", "closed", "due", "updated").unionByName(dated(fact_merge_request(spark, t), "merged"))
    return f.select("team", "r").filter("r.month_key is not null").groupBy("team", "r.role", "r.month_key").agg(
        F.count(F.lit(1)).alias("cards"))


def q_event_target_gate(spark, sf_dir):
    """Every event has the target of its kind (D8); the event fact keeps the grain of the deduplicated log."""
    t = Tables(spark, sf_dir)
    f = materialize(fact_event(spark, t))
    one = side_by_side(f.agg(F.count_if(~target_ok()).alias("bad"), F.count(F.lit(1)).alias("rows"), F.lit(0).alias("zero")),
                       ev.dedupe_events(si.raw_card_events(t)).agg(F.count(F.lit(1)).alias("log")))
    return quality.gate_rows(one, [("events_without_their_target", "bad", "zero"), ("event_rows_eq_log", "rows", "log")])


def q_dwell_gates(spark, sf_dir):
    """No interval ends before it starts, and the cards of the stages add up to the stage summary."""
    t = Tables(spark, sf_dir)
    i = materialize(evp.intervals(spark, t))
    d = iv.stage_cards(i, evp.LIMIT_HOURS).agg(
        F.count(F.lit(1)).alias("d_cards"), F.sum("passes").cast("bigint").alias("d_passes"), F.sum("over_limit").cast("bigint").alias("d_over"),
        F.sum("intervals_open_at_cutoff").cast("bigint").alias("d_open"))
    s = iv.dwell_summary(i, evp.LIMIT_HOURS).agg(
        F.sum("cards").cast("bigint").alias("s_cards"), F.sum("passes").cast("bigint").alias("s_passes"),
        F.sum("cards_over_limit").cast("bigint").alias("s_over"), F.sum("intervals_open_at_cutoff").cast("bigint").alias("s_open"))
    n = i.agg(F.count_if(F.col("left_at") < F.col("entered_at")).alias("negative"), F.lit(0).alias("zero"))
    return quality.gate_rows(side_by_side(n, d, s), [
        ("intervals_with_negative_dwell", "negative", "zero"), ("detail_cards_eq_summary", "d_cards", "s_cards"),
        ("detail_passes_eq_summary", "d_passes", "s_passes"), ("detail_over_limit_eq_summary", "d_over", "s_over"),
        ("detail_open_eq_summary", "d_open", "s_open")])


#: A pass of six minutes or less is drawn at the floor of the dwell scale.
FLOOR_MICROS = 360_000_000


def q_floor_passes(spark, sf_dir):
    """Passes per team and stage, and those at the floor of the dwell scale (M6)."""
    i = evp.intervals(spark, Tables(spark, sf_dir)).withColumn("micros", elapsed_micros("entered_at", "left_at"))
    return i.groupBy("team", "stage").agg(
        F.count(F.lit(1)).alias("passes"), F.count_if(F.col("micros") <= FLOOR_MICROS).alias("floor_passes")).withColumn(
        "pct_floor", F.col("floor_passes").cast("double") * 100 / F.col("passes").cast("double"))


def register_views(spark, sf_dir, prefix: str = "") -> list[str]:
    """Persist the facts, dimensions and subject views as temporary SQL views of the session (S15, D7); their names."""
    for name, build in QUERIES.items():
        if not name.endswith("gates") and not name.endswith("gate"):
            build(spark, sf_dir).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in QUERIES if not name.endswith(("gates", "gate"))]


def text_copy(df: DataFrame) -> DataFrame:
    """``df`` written as text, read back and cast to its types (S12); arrays travel as JSON."""
    to_text = [(F.to_json(F.col(c)) if d.startswith("array") else F.col(c).cast("string")).alias(c) for c, d in df.dtypes]
    back = materialize(df.select(to_text))
    return back.select([(F.from_json(F.col(c), d) if d.startswith("array") else F.col(c).cast(d)).alias(c) for c, d in df.dtypes])


def q_copy_gates(spark, sf_dir):
    """Copies of all tables as text, read back and cast: rows, nulls per column and values against the source."""
    t = Tables(spark, sf_dir)
    return quality.round_trip({name: (getattr(t, name), text_copy(getattr(t, name))) for name in TABLES})


def label_aliases(spark) -> DataFrame:
    """Every listed spelling of a label (trimmed, upper case, without dots and blanks) and the label it stands for."""
    low, high = text.ARTIFACT_RANGE
    rows = [(f"ART{n:0{w}d}", f"ART-{n:02d}") for n in range(low, high + 1) for w in (1, 2) if n < 10 or w == 2]
    rows += [(a.replace(" ", ""), label) for label, names in text.SIZE_ALIASES.items() for a in names]
    rows += [(a, "BUG") for a in text.BUG_ALIASES]
    return spark.createDataFrame(sorted(set(rows)), "spelling string, label string")


def labels_by_table(spark, t: Tables) -> DataFrame:
    """Distinct labels set or removed on cards: the raw log without board columns, spellings replaced by the alias table."""
    log = si.raw_card_events(t).filter("column is not null").select("team", F.upper(F.trim("column")).alias("named"), "column").distinct()
    marks = log.join(si.board_columns(spark).select("team", "column"), ["team", "column"], "left_anti")
    spelling = F.regexp_replace("named", r"[. ]", "")
    marks = marks.withColumn("spelling", spelling).join(F.broadcast(label_aliases(spark)), "spelling", "left")
    return marks.select(F.coalesce("label", "named").alias("label")).distinct()


def members_by_line(t: Tables) -> DataFrame:
    """team, person: suppliers of the team's own region with a line of an order of that team, from the raw lines."""
    teams = t.orders.join(si.customer_team(t), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), "team")
    home = conc.supplier_team(t).select(F.col("s_suppkey").alias("l_suppkey"), F.col("supp_team").alias("team"))
    lines = t.lineitem.filter(F.col("l_suppkey") % 10 != 0).join(teams, "l_orderkey").select("team", "l_suppkey").distinct()
    return lines.join(home, ["team", "l_suppkey"], "left_semi").select("team", F.col("l_suppkey").cast("string").alias("person"))


def axis_units_by_card(spark, t: Tables) -> DataFrame:
    """team, slice, axis, who, units: distinct (card, axis) and (card, person) pairs of the raw lines, each card shared by their numbers."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    words = li.join(t.part.select("p_partkey", F.upper(F.regexp_extract("p_name", r"^[^ ]*", 0)).alias("word")), F.col("l_partkey") == F.col("p_partkey"))
    pairs = words.join(F.broadcast(conc.axis_table(spark)), "word").select("l_orderkey", "axis").distinct()
    people = li.filter((F.col("l_linenumber") <= conc.LISTED) & (F.col("l_suppkey") % 10 != 0)).select("l_orderkey", "l_suppkey").distinct()
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_suppkey"))  # a card's own lines
    people = people.withColumn("place", place).filter(F.col("place") <= conc.LISTED).drop("place")
    shares = pairs.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("axes")).join(
        people.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("people")), "l_orderkey")
    cards = t.orders.join(si.customer_team(t), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), "team", si.order_sprint().alias("sprint"))
    own = members_by_line(t).withColumn("l_suppkey", F.col("person").cast("bigint"))
    held = (cards.join(people, "l_orderkey").join(own, ["team", "l_suppkey"], "left_semi").join(pairs, "l_orderkey").join(shares, "l_orderkey")
            .withColumn("slice", F.explode(F.array_compact(F.array(F.lit(conc.sl.ALL_SLICE), F.col("sprint"))))))
    return held.groupBy("team", "slice", "axis", F.col("l_suppkey").cast("string").alias("who")).agg(
        F.sum(F.expr(f"{conc.UNITS} div (axes * people)")).alias("units"))


def gini_again(t: Tables) -> DataFrame:
    """team, slice, measure, gini from the differences of all pairs, over the records line by line."""
    members = materialize(members_by_line(t))
    rows = conc.records(t).join(members, ["team", "person"], "left_semi")
    rows = rows.withColumn("slice", F.explode(F.array_compact(F.array(F.lit(conc.sl.ALL_SLICE), F.col("sprint")))))
    per = rows.groupBy(*conc.GROUP, "person").agg(F.sum("value").alias("value"))
    sizes = per.select(*conc.GROUP).distinct().join(members.groupBy("team").agg(F.count(F.lit(1)).alias("members")), "team")
    d = recount.pair_differences(per, conc.GROUP, "value", sizes).filter("total > 0")
    return d.select(*conc.GROUP, conc.cc.exact_ratio(
        F.col("differences"), (F.col("total") * F.col("members").cast("decimal(20,0)")).cast("decimal(38,0)")).alias("gini"))


def recount_tables(spark, t: Tables) -> dict[str, tuple[DataFrame, DataFrame, list[str], str]]:
    """Per gate the figures of the reports, the figures counted again, their keys and their value (Q13)."""
    reported = pl.exact_median(plan.base(spark, t).filter("in_chart"), ["team"], "actual_days", "m")
    sized = plan.sized_cards(spark, t).filter("size is not null and closed_at is not null").select("team", elapsed_micros("created_at", "closed_at").alias("micros"))
    days = lambda c: F.col(c).cast("double") / F.lit(float(MICROS_PER_DAY))
    again = recount.middle(sized, ["team"], "micros").select("team", ((days("low_middle") + days("high_middle")) / 2).alias("m"))

    e = ev.classify_events(ev.dedupe_events(si.raw_card_events(t)), si.board_columns(spark)).filter(F.col("kind") == ev.KIND_LABEL)
    labels = e.groupBy(F.col("canonical_label").alias("label")).agg(F.lit(1).alias("seen"))

    _, units = conc.axis_sums(spark, t)
    cell = ["team", "slice", "axis"]
    held = units.filter(F.col("who") != "(grupo)")
    top = conc.cc.top_k_share(held, cell, "units", "who", 2).select(*cell, F.col("top_total").cast("bigint").alias("top2"))
    state = recount.largest(axis_units_by_card(spark, t), cell, "units", 2)
    top_again = state.select(*cell, F.aggregate("largest", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("top2"))

    gini = conc.cc.gini(conc.member_totals(t), conc.GROUP, blocks=conc.blocks(t)).select(*conc.GROUP, "gini")
    return {"medians": (reported, again, ["team"], "m"),
            "labels": (labels, labels_by_table(spark, t).withColumn("seen", F.lit(1)), ["label"], "seen"),
            "top2": (top, top_again, cell, "top2"),
            "gini": (gini, gini_again(t), conc.GROUP, "gini")}


def recount_gates(tables: dict[str, tuple[DataFrame, DataFrame, list[str], str]]) -> DataFrame:
    """Per figure two gates: both ways have the same number of figures, and none differs."""
    ones, gates = [], []
    for name, (first, second, keys, value) in tables.items():
        ones += [recount.differing(first, second, keys, value, f"{name}_differ"),
                 first.agg(F.count(F.lit(1)).alias(f"{name}_first")), second.agg(F.count(F.lit(1)).alias(f"{name}_second"))]
        gates += [(f"{name}_that_differ", f"{name}_differ", "zero"), (f"{name}_eq_recount", f"{name}_first", f"{name}_second")]
    return quality.gate_rows(side_by_side(*ones).withColumn("zero", F.lit(0)), gates)


def q_recount_gates(spark, sf_dir):
    """Medians, labels, the two largest holders and Gini indices, counted a second way that shares no step with the first (Q13)."""
    return recount_gates(recount_tables(spark, Tables(spark, sf_dir)))


def q_excluded_daily(spark, sf_dir):
    """Merges and inherited commits per team and day."""
    t = Tables(spark, sf_dir)
    c = si.commits(t).join(F.broadcast(si.teams(t)), "team")
    old = F.col("committed_at") < F.col("created_at")
    return c.filter(old | F.col("is_merge")).groupBy("team", F.to_date("authored_at").alias("day")).agg(
        F.count_if(F.col("is_merge") & ~old).alias("merges"), F.count_if(old).alias("inherited"))


def q_period_presets(spark, sf_dir):
    """Commits per team under the period presets: last 30 days of the data, one sprint, and from/to days."""
    t = Tables(spark, sf_dir)
    c = cal.authored(si.commits(t), si.teams(t))
    recent = cal.recent_window(c, "authored_at", 30).withColumn("preset", F.lit("last_30_days"))
    first = sprints(t).filter("starts_on is not null").agg(F.min(F.struct("starts_on", "due_on")).alias("s")).select("s.*")
    day = F.to_date("authored_at")
    sprint = c.filter((day >= first.select("starts_on").scalar()) & (day <= first.select("due_on").scalar())).withColumn("preset", F.lit("first_dated_sprint"))
    span = c.filter(day.between(F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date"))).withColumn("preset", F.lit("1997"))
    every = recent.unionByName(sprint).unionByName(span)
    return every.groupBy("preset", "team").agg(F.count(F.lit(1)).alias("commits"), F.sum("lines_total").cast("bigint").alias("lines"))


QUERIES = {
    "fact_commit": q_fact_commit, "fact_merge_request": q_fact_merge_request, "fact_card": q_fact_card, "fact_event": q_fact_event,
    "dim_sprint": q_dim_sprint, "dim_status": q_dim_status, "dim_label": q_dim_label, "dim_board_column": q_dim_board_column,
    "authored_commits": q_authored_commits, "board_moves": q_board_moves, "label_marks": q_label_marks, "role_dates": q_role_dates,
    "event_target_gate": q_event_target_gate, "dwell_gates": q_dwell_gates, "copy_gates": q_copy_gates,
    "recount_gates": q_recount_gates, "excluded_daily": q_excluded_daily, "period_presets": q_period_presets,
    "floor_passes": q_floor_passes,
}

_TEAMS = keys.TEAM_KEYS_SQL + ", " + keys.SPRINT_KEYS_SQL
COMMIT_SQL = "WITH " + si.COMMITS_SQL + "," + _TEAMS + f""",
fc_ AS (
  SELECT team_sk, c.team, commit_id, {keys.person_sql(keys.roster_sql('author_id'))} AS author_sk, author_id, CAST(strftime(authored_at, '%Y%m%d') AS INTEGER) AS authored_date_key,
         CAST(hour(authored_at) AS INTEGER) AS authored_hour_key, CAST(strftime(late, '%Y%m%d') AS INTEGER) AS committed_date_key,
         CAST(hour(late) AS INTEGER) AS committed_hour_key, title, is_merge, late < g.created_at AS is_template_history,
         lag <> 0 AS is_third_party, lines_added, lines_removed, lines_total, lines_added - lines_removed AS lines_net, lag AS authoring_lag_s
  FROM (SELECT *, CASE WHEN commit_id % 25 = 0 THEN commit_id % 7200 ELSE 0 END AS lag,
               authored_at + to_seconds(CASE WHEN commit_id % 25 = 0 THEN commit_id % 7200 ELSE 0 END) AS late FROM commits_) c
  JOIN teams_ g ON g.team = c.team JOIN tk_ ON tk_.team = c.team),
mr_ AS (
  SELECT team, o.o_orderkey AS mr, o_custkey AS author_id, o_orderdate AS created_at,
         CASE WHEN o_orderstatus = 'F' THEN closed_at END AS merged_at, CASE WHEN o_orderstatus = 'P' THEN closed_at END AS closed_at,
         CASE WHEN closed_at IS NULL OR o_orderstatus = 'O' THEN 'opened' WHEN o_orderstatus = 'F' THEN 'merged' ELSE 'closed' END AS status,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS sprint
  FROM orders o JOIN cust_team_ ON c_custkey = o_custkey LEFT JOIN closes_ l ON l.o_orderkey = o.o_orderkey)
"""
EVENT_SQL = evp.EVENTS_WITH + ", " + _TEAMS + """,
lk_ AS (SELECT label, CAST(row_number() OVER (ORDER BY label) AS BIGINT) AS label_sk FROM (
  SELECT canonical_label AS label FROM treated_ WHERE canonical_label IS NOT NULL
  UNION VALUES ('SIZE_PP'), ('SIZE_P'), ('SIZE_M'), ('SIZE_G'), ('SIZE_GG'))),
used_ AS (SELECT DISTINCT team, "column" FROM dedup_),
dbc_ AS (SELECT b.team || '|Scrum Board|' || b."column" AS column_key, b.team, 'Scrum Board' AS board, b."column", b.position
         FROM board_ b JOIN used_ u ON u.team = b.team AND u."column" = b."column"),
fe_ AS (SELECT event_id, team_sk, t.team, card, CAST(3 - is_bot AS BIGINT) AS person_sk, person, sprint_sk, t.sprint, CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key,
               event_hour AS hour_key, column_key, label_sk, canonical_label AS label_key, label_category, kind, action, is_bot,
               seq_in_card, hours_to_next, event_counter
        FROM treated_ t LEFT JOIN dbc_ d ON d.team = t.team AND d."column" = t.board_column JOIN tk_ ON tk_.team = t.team
        LEFT JOIN sk_ ON sk_.team = t.team AND sk_.sprint = t.sprint LEFT JOIN lk_ ON lk_.label = canonical_label)
"""
_R = evp.sql_round_ratio
CARD_SQL = plan.PLAN_SQL + "," + EVENT_SQL[len("WITH "):] + f""",
fk_ AS (
  SELECT team_sk, c.team, c.card, {keys.person_sql(keys.roster_sql('c.author_id'))} AS author_sk,
         CASE WHEN a.assignee <> '(vazio)' THEN {keys.person_sql("split_part(a.assignee, ';', 1)")} END AS assignee_sk,
         CASE WHEN c.closed_at IS NOT NULL THEN {keys.person_sql(keys.roster_sql('(c.author_id + 3)'))} END AS closed_by_sk,
         sprint_sk, CAST(if(c.closed_at IS NULL, 3, 1) AS BIGINT) AS status_sk, label_sk AS size_sk, c.author_id,
         c.sprint, c.state AS status, c.size, 'card #' || CAST(c.card AS VARCHAR) AS title,
         CAST(strftime(c.created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
         CAST(hour(c.created_at) AS INTEGER) AS created_hour_key, CAST(strftime(c.closed_at, '%Y%m%d') AS INTEGER) AS closed_date_key,
         CAST(strftime(due, '%Y%m%d') AS INTEGER) AS due_date_key,
         CAST(strftime(greatest(c.created_at, s.shipped_at), '%Y%m%d') AS INTEGER) AS updated_date_key,
         c.closed_at IS NOT NULL AS is_closed, due IS NOT NULL AS has_due,
         CASE WHEN due IS NOT NULL THEN coalesce(CAST(c.closed_at AS DATE) > due, true) END AS is_overdue, c.card % 3 <> 0 AS has_description,
         a.assignee <> '(vazio)' AS has_assignee,
         CASE WHEN c.closed_at IS NOT NULL THEN {_R('epoch_us(c.closed_at) - epoch_us(c.created_at)', '3600000000', 2)} END AS lead_time_hours,
         CASE WHEN c.closed_at IS NOT NULL THEN {_R('epoch_us(c.closed_at) - epoch_us(c.created_at)', '86400000000', 2)} END AS lead_time_days,
         c.card % {COMMENTS_MOD} AS comments, CAST(coalesce(len(string_split(a.labels, ';')), 0) AS INTEGER) AS label_count,
         coalesce(v.n, 0) AS event_count, CASE WHEN c.card % {ESTIMATED_EVERY} = 0 THEN c.card % 8 * 3600 ELSE 0 END AS estimated_s, 1 AS card_counter
  FROM (SELECT *, CASE WHEN card % {DUE_EVERY} = 0 THEN CAST(created_at AS DATE) + {DUE_DAYS} END AS due FROM scards_) c
  JOIN acards_ a ON a.team = c.team AND a.card = c.card JOIN tk_ ON tk_.team = c.team
  LEFT JOIN sk_ ON sk_.team = c.team AND sk_.sprint = c.sprint LEFT JOIN lk_ ON lk_.label = 'SIZE_' || c.size
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped_at FROM lineitem GROUP BY 1) s ON s.l_orderkey = c.card
  LEFT JOIN (SELECT card, count(*) AS n FROM dedup_ GROUP BY 1) v ON v.card = c.author_id)
"""
MR_SQL = f"""
        SELECT team_sk, m.team, mr, {keys.person_sql(keys.roster_sql('author_id'))} AS author_sk,
               CASE WHEN merger IS NOT NULL THEN {keys.person_sql(keys.roster_sql('merger'))} END AS merged_by_sk,
               CASE WHEN author_id % 4 <> 0 THEN {keys.person_sql(keys.roster_sql('(author_id + 2)'))} END AS reviewer_sk,
               sprint_sk, {keys.STATUS_SQL.format(s='status')} AS status_sk,
               author_id, merger AS merged_by_id, CASE WHEN author_id % 4 <> 0 THEN author_id + 2 END AS reviewer_id,
               m.sprint, status, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
               CAST(hour(created_at) AS INTEGER) AS created_hour_key, CAST(strftime(merged_at, '%Y%m%d') AS INTEGER) AS merged_date_key,
               CAST(strftime(closed_at, '%Y%m%d') AS INTEGER) AS closed_date_key, branch AS target_branch, status = 'merged' AS is_merged,
               mr % 20 = 0 AS is_draft, author_id % 4 <> 0 AS has_reviewer, coalesce(merger = author_id, false) AS is_self_merge,
               branch = 'main' AS is_to_default_branch,
               CASE WHEN merged_at IS NOT NULL THEN {_R('epoch_us(merged_at) - epoch_us(created_at)', '3600000000', 2)} END AS hours_to_merge,
               author_id % 6 AS comments, 1 AS mr_counter
        FROM (SELECT *, ['main', 'dev', 'develop'][mr % 3 + 1] AS branch,
                     CASE WHEN status = 'merged' THEN author_id + CAST(author_id % 7 <> 0 AS INTEGER) END AS merger FROM mr_) m JOIN tk_ USING (team)
        LEFT JOIN sk_ ON sk_.team = m.team AND sk_.sprint = m.sprint"""


def plan_columns(table: str) -> list[str]:
    from flowcube.plans.quality import SCHEMAS
    return [c.split()[0] for c in SCHEMAS[table].split(", ")]


def _gates(with_sql: str, rows: list[tuple[str, str, str]]) -> str:
    parts = [f"SELECT '{g}' AS gate, CAST({o} AS VARCHAR) AS observed, CAST({e} AS VARCHAR) AS expected" for g, o, e in rows]
    return f"{with_sql} SELECT *, observed = expected AS ok FROM ({' UNION ALL '.join(parts)})"


ORACLE = {
    "fact_commit": COMMIT_SQL + "SELECT * FROM fc_",
    "authored_commits": COMMIT_SQL + "SELECT * FROM fc_ WHERE NOT is_template_history",
    "fact_merge_request": COMMIT_SQL + MR_SQL,
    "fact_card": CARD_SQL + "SELECT * FROM fk_",
    "role_dates": CARD_SQL + """
        SELECT team, role, month_key, count(*) AS cards FROM (
          SELECT team, 'created' AS role, created_date_key // 100 AS month_key FROM fk_
          UNION ALL SELECT team, 'closed', closed_date_key // 100 FROM fk_
          UNION ALL SELECT team, 'due', due_date_key // 100 FROM fk_
          UNION ALL SELECT team, 'updated', updated_date_key // 100 FROM fk_
          UNION ALL SELECT team, 'merged', CAST(strftime(closed_at, '%Y%m') AS INTEGER) FROM cards_ JOIN orders o ON o.o_orderkey = card
                    WHERE o_orderstatus = 'F') WHERE month_key IS NOT NULL GROUP BY ALL""",
    "fact_event": EVENT_SQL + "SELECT * FROM fe_",
    "board_moves": EVENT_SQL + """
        SELECT event_id, fe_.team, card, action, "column", position, date_key, hour_key, seq_in_card
        FROM fe_ JOIN dbc_ USING (column_key)""",
    "label_marks": EVENT_SQL + """
        SELECT event_id, team, card, action, label_key, label_category, date_key, hour_key FROM fe_ WHERE label_key IS NOT NULL""",
    "dim_board_column": EVENT_SQL + """
        SELECT *, position = (SELECT min(position) FROM dbc_ x WHERE x.team = d.team) AS is_first,
               position = (SELECT max(position) FROM dbc_ x WHERE x.team = d.team) AS is_last FROM dbc_ d""",
    "event_target_gate": _gates(EVENT_SQL, [
        ("events_without_their_target", "(SELECT count(*) FROM fe_ WHERE (kind = 'MUDANCA_COLUNA') <> (column_key IS NOT NULL) "
         "OR (kind = 'MARCACAO_ROTULO') <> (label_key IS NOT NULL))", "0"),
        ("event_rows_eq_log", "(SELECT count(*) FROM fe_)", "(SELECT count(*) FROM dedup_)")]),
    "dim_sprint": "WITH " + si.COMMITS_SQL + "," + _TEAMS + "," + si.EVENTS_SQL + f""",
        s AS (SELECT team, sprint, min(CAST(created_at AS DATE)) AS a, max(CAST(created_at AS DATE)) AS b, team = '{DATED_TEAM}' AS dated FROM cards_
              WHERE sprint IS NOT NULL GROUP BY ALL
              UNION ALL SELECT team, sprint, start_date, end_date, team = '{si.CALENDAR_TEAM}' FROM sprint_cal_, (VALUES ('T0'), ('T1'), ('T2')) x(team))
        SELECT sprint_sk, s.team, s.sprint, CAST((SELECT count(*) FROM s x WHERE x.team = s.team AND x.sprint <= s.sprint) AS INTEGER) AS sprint_no,
               if(dated, a, NULL) AS starts_on, if(dated, b, NULL) AS due_on,
               CAST(if(dated, b - a, NULL) AS INTEGER) AS days,
               if(dated, 'INFORMADA', 'AUSENTE') AS date_origin FROM s JOIN sk_ ON sk_.team = s.team AND sk_.sprint = s.sprint""",
    "dim_status": COMMIT_SQL + f"""
        , s AS (SELECT state AS status FROM cards_ UNION SELECT status FROM mr_)
        SELECT {keys.STATUS_SQL.format(s='status')} AS status_sk, status,
               CASE status WHEN 'opened' THEN 'aberto' WHEN 'closed' THEN 'fechado' ELSE 'mesclado' END AS name,
               status <> 'opened' AS is_ended, status = 'merged' AS is_success FROM s""",
    "dim_label": EVENT_SQL + """
        SELECT label_sk, label, coalesce((SELECT any_value(label_category) FROM treated_ WHERE canonical_label = label), 'TAMANHO') AS category FROM lk_""",
    "dwell_gates": _gates(evp.EVENTS_WITH, [
        ("intervals_with_negative_dwell", "(SELECT count(*) FROM intervals_ WHERE left_at < entered_at)", "0"),
        ("detail_cards_eq_summary", "(SELECT count(*) FROM stage_cards_)", "(SELECT count(*) FROM per_card_)"),
        ("detail_passes_eq_summary", "(SELECT sum(passes) FROM stage_cards_)", "(SELECT count(*) FROM intervals_)"),
        ("detail_over_limit_eq_summary", "(SELECT sum(over_limit) FROM stage_cards_)", "(SELECT count(*) FROM per_card_ WHERE micros > 172800000000)"),
        ("detail_open_eq_summary", "(SELECT sum(intervals_open_at_cutoff) FROM stage_cards_)", "(SELECT sum(open_at_cutoff) FROM per_card_)")]),
    "floor_passes": evp.EVENTS_WITH + f"""
        SELECT team, stage, count(*) AS passes, count_if(epoch_us(left_at) - epoch_us(entered_at) <= {FLOOR_MICROS}) AS floor_passes,
               CAST(count_if(epoch_us(left_at) - epoch_us(entered_at) <= {FLOOR_MICROS}) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) AS pct_floor
        FROM intervals_ GROUP BY team, stage""",
    "copy_gates": _gates("", [x for name in TABLES for x in [
        (f"rows_eq_source:{name}", *[f"(SELECT count(*) FROM {name})"] * 2), (f"columns_that_differ:{name}", "0", "0"),
        (f"rows_that_differ:{name}", "0", "0"),
        *[(f"nulls_eq_source:{name}.{c}", *[f"(SELECT count(*) - count({c}) FROM {name})"] * 2) for c in plan_columns(name)]]]),
    "excluded_daily": "WITH " + si.COMMITS_SQL + """
        SELECT c.team, CAST(authored_at AS DATE) AS day, count_if(is_merge AND committed_at >= created_at) AS merges,
               count_if(committed_at < created_at) AS inherited
        FROM commits_ c JOIN teams_ g ON g.team = c.team WHERE is_merge OR committed_at < created_at GROUP BY ALL""",
    "period_presets": "WITH " + si.COMMITS_SQL + f""",
        a AS (SELECT c.team, authored_at, lines_total FROM commits_ c JOIN teams_ g ON g.team = c.team
              WHERE NOT is_merge AND committed_at >= g.created_at),
        s AS (SELECT min(CAST(created_at AS DATE)) AS x, max(CAST(created_at AS DATE)) AS y FROM cards_
              WHERE team = '{DATED_TEAM}' AND sprint = (SELECT min(sprint) FROM cards_ WHERE team = '{DATED_TEAM}')),
        p AS (SELECT 'last_30_days' AS preset, * FROM a WHERE authored_at > (SELECT max(authored_at) FROM a) - INTERVAL 30 DAY
              UNION ALL SELECT 'first_dated_sprint', a.* FROM a, s WHERE CAST(authored_at AS DATE) BETWEEN x AND y
              UNION ALL SELECT '1997', * FROM a WHERE year(authored_at) = 1997)
        SELECT preset, team, count(*) AS commits, CAST(sum(lines_total) AS BIGINT) AS lines FROM p GROUP BY ALL""",
    "recount_gates": _gates(plan.PLAN_SQL + "," + EVENT_SQL[len("WITH "):], [
        ("medians_that_differ", "0", "0"),
        ("medians_eq_recount", *["(SELECT count(DISTINCT team) FROM base_ WHERE in_chart)"] * 2),
        ("labels_that_differ", "0", "0"),
        ("labels_eq_recount", "(SELECT count(DISTINCT canonical_label) FROM treated_)",
         "(SELECT count(*) FROM (SELECT canonical_label FROM treated_ WHERE canonical_label IS NOT NULL GROUP BY 1))"),
        ("top2_that_differ", "0", "0"),
        ("top2_eq_recount", *["(SELECT count(*) FROM top2_ WHERE holders > 0)"] * 2),
        ("gini_that_differ", "0", "0"),
        ("gini_eq_recount", *["(SELECT count(*) FROM slice_ WHERE t > 0)"] * 2)]),
}
