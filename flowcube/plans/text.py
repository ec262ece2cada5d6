"""Lists, citations and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowcube.functions.scalars import side_by_side
from flowcube.functions import text
from flowcube.operators import calendar as cal
from flowcube.operators import events as ev
from flowcube.plans import standins as si
from flowcube.operators.materialize import materialize
from flowcube.sources.tables import Tables


def part_labels(t: Tables):
    """Multi-valued label field stand-in: the two words of p_name plus the lower-cased type.

    Names like 'small ring' of type SMALL carry the same value twice, as a list may.
    """
    return t.part.select(
        F.col("p_partkey").alias("card"),
        F.concat(F.regexp_replace("p_name", " ", ";"), F.lit(";"), F.lower("p_type")).alias("labels"),
        F.col("p_size").cast("bigint").alias("comments"))


def q_explode_weighted(spark, sf_dir):
    return text.explode_weighted(part_labels(Tables(spark, sf_dir)), ["card"], "labels", value_name="label")


def q_explode_roundtrip(spark, sf_dir):
    src = part_labels(Tables(spark, sf_dir))
    ex = text.explode_weighted(src, ["card"], "labels", value_name="label")
    back = text.rejoin_parts(ex, ["card"], "label")
    j = src.filter(F.col("labels").isNotNull()).join(back, "card", "left")
    exploded = ex.agg(F.count(F.lit(1)).alias("exploded_rows"),
                      F.sum("weight").alias("weight_total"))
    checked = j.agg(F.count(F.lit(1)).alias("records"),
                    F.count_if(~F.col("rejoined").eqNullSafe(F.col("labels"))).alias("mismatches"))
    return side_by_side(checked, exploded).select(
        "records", "exploded_rows", F.round("weight_total", 6).alias("weight_total"), "mismatches")


def q_allocated_sum(spark, sf_dir):
    """Comments of a label's cards, each card's split evenly over its values.

    Whole comments are summed per (label, number of values); the few sums, each divided once, are added in
    the order of n, so the result does not depend on how rows are dealt out.
    """
    src = part_labels(Tables(spark, sf_dir))
    ex = text.explode_weighted(src.withColumn("card_key", F.struct("card", "comments")), ["card_key"], "labels", value_name="label")
    per = ex.select("label", "card_key.card", "card_key.comments", "n_values")
    one = per.groupBy("label", "card").agg(F.max("comments").alias("comments"), F.max("n_values").alias("n_values"), F.count(F.lit(1)).alias("k"))
    by_n = one.groupBy("label", "n_values").agg(F.count(F.lit(1)).alias("cards"), F.sum(F.col("comments") * F.col("k")).alias("comments"))
    parts = F.aggregate(F.array_sort(F.collect_list(F.struct("n_values", "comments"))), F.lit(0.0),
                        lambda acc, x: acc + x["comments"].cast("double") / x["n_values"])
    return by_n.groupBy("label").agg(F.sum("cards").cast("bigint").alias("cards"), F.round(parts, 6).alias("allocated_comments"))


def card_keys(t: Tables):
    """(team, card) of every orders-side card."""
    return si.orders_with_team(t).select("team", F.col("o_orderkey").alias("card"))


def citation_links(t: Tables):
    """Authored commit -> cited card links (M9); dangling citations kept with a NULL card."""
    return t.memo("citation_links", lambda: _citation_links(t))


#: What a link tells about its commit and citation; a report names those that it leaves out.
LINK_DETAILS = ["cited_in", "authored_at", "title", "lines_added", "lines_removed"]


def _citation_links(t: Tables, without: tuple[str, ...] = ()):
    a = cal.authored(si.commits(t), si.teams(t))
    nums, src = text.citations_with_fallback(F.col("title"), F.col("message"))
    cited = (a.select("team", "commit_id", "author_id", "authored_at", "title", "lines_added", "lines_removed",
                      nums.alias("nums"), src.alias("cited_in"))
              .select("*", F.explode("nums").alias("cited_number")).drop("nums", *without))
    keys = card_keys(t).withColumnRenamed("card", "cited_number").withColumn("card", F.col("cited_number"))
    j = cited.join(keys, ["team", "cited_number"], "left")
    head, *rest = LINK_DETAILS
    named = lambda names: [c for c in names if c not in without]
    return materialize(j).select("team", "card", "cited_number", F.col("card").isNull().cast("int").alias("is_dangling"),
                                 *named([head]), "commit_id", "author_id", *named(rest))


def q_ref_citations(spark, sf_dir):
    return citation_links(Tables(spark, sf_dir))


def q_ref_dangling(spark, sf_dir):
    links = citation_links(Tables(spark, sf_dir))
    return links.groupBy("team").agg(
        F.countDistinct("commit_id").alias("citing_commits"),
        F.count(F.lit(1)).alias("links"),
        F.sum("is_dangling").cast("bigint").alias("dangling_links"),
        F.countDistinct("card").alias("linked_cards"))


def scan_citations(df, col, label):
    """Alternate path (R2 as the reference's recursive scan): cut the text after every
    '#', read the leading digits, keep them when written without a leading zero and
    not followed by a letter or digit."""
    parts = F.split(F.coalesce(F.col(col), F.lit("")), "#")
    seg = F.explode(F.slice(parts, 2, F.size(parts) - 1))
    s = df.select("team", "commit_id", seg.alias("seg"))
    digits = F.regexp_extract("seg", r"^[0-9]+", 0)
    nxt = F.substring(F.col("seg"), F.length(digits) + 1, 1)
    ok = (digits != "") & ((digits == "0") | (F.substring(digits, 1, 1) != "0")) & ~nxt.rlike("[0-9A-Za-z]")
    return (s.filter(ok).select("team", "commit_id", digits.try_cast("bigint").alias("cited_number")).filter("cited_number is not null")
             .distinct().withColumn("cited_in", F.lit(label)))


def q_reconcile_pairs(spark, sf_dir):
    """Citation pairs from the regex path vs the segment-scan path."""
    t = Tables(spark, sf_dir)
    a = citation_links(t).select("team", "commit_id", "cited_number")
    au = cal.authored(si.commits(t), si.teams(t))
    tt = scan_citations(au, "title", "title")
    mm = scan_citations(au, "message", "message")
    mm = mm.join(tt.select("team", "commit_id").distinct(), ["team", "commit_id"], "left_anti")
    b = tt.unionByName(mm).select("team", "commit_id", "cited_number")
    from flowcube.operators.quality import symmetric_difference
    diff = symmetric_difference(a, b, "regex", "scan")
    return side_by_side(a.agg(F.count(F.lit(1)).alias("pairs_regex")),
                        b.agg(F.count(F.lit(1)).alias("pairs_scan")),
                        diff.agg(F.count_if(F.col("only_in") == "regex").alias("only_in_regex"),
                                 F.count_if(F.col("only_in") == "scan").alias("only_in_scan")))


def q_label_canon(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e = ev.classify_events(ev.dedupe_events(si.raw_card_events(t)), si.board_columns(spark))
    lab = e.filter(F.col("kind") == ev.KIND_LABEL)
    return (lab.groupBy(F.upper(F.trim("column")).alias("raw_label"))
               .agg(F.count(F.lit(1)).alias("occurrences"))
               .select("raw_label", text.canonical_label(F.col("raw_label")).alias("canonical_label"),
                       "occurrences")
               .withColumn("category", text.label_category(F.col("canonical_label"))))


def q_missing_label(spark, sf_dir):
    """Closed cards without a size label (J10), per team."""
    t = Tables(spark, sf_dir)
    c = si.cards(t)
    sizes = spark.createDataFrame(si.PRIORITY_SIZE, "priority string, size string")
    closed = c.filter(F.col("state") == "closed")
    missing = closed.join(F.broadcast(sizes), "priority", "left_anti")
    return (closed.groupBy("team").agg(F.count(F.lit(1)).alias("closed_cards"))
                  .join(missing.groupBy("team").agg(F.count(F.lit(1)).alias("closed_without_size")), "team", "left")
                  .select("team", "closed_cards",
                          F.coalesce("closed_without_size", F.lit(0)).cast("bigint").alias("closed_without_size")))


QUERIES = {
    "explode_weighted": q_explode_weighted,
    "explode_roundtrip": q_explode_roundtrip,
    "allocated_sum": q_allocated_sum,
    "ref_citations": q_ref_citations,
    "ref_dangling": q_ref_dangling,
    "reconcile_pairs": q_reconcile_pairs,
    "label_canon": q_label_canon,
    "missing_label": q_missing_label,
}

PARTS_SQL = """
plab AS (SELECT p_partkey AS card, replace(p_name, ' ', ';') || ';' || lower(p_type) AS labels,
                CAST(p_size AS BIGINT) AS comments FROM part),
ex AS (SELECT card, CAST(pos AS INTEGER) AS position, parts[pos] AS label, CAST(len(parts) AS INTEGER) AS n_values,
              CAST(1.0 AS DOUBLE) / len(parts) AS weight
       FROM (SELECT card, string_split(labels, ';') AS parts FROM plab WHERE labels IS NOT NULL),
            LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS pos))
"""

LINKS_SQL = si.COMMITS_SQL + """,
authored_ AS (SELECT c.* FROM commits_ c JOIN teams_ g ON g.team = c.team
              WHERE c.committed_at >= g.created_at AND NOT c.is_merge),
cit_ AS (SELECT *, list_distinct(list_transform(
                     regexp_extract_all(coalesce(title, ''), '#(0|[1-9][0-9]*)([^0-9A-Za-z]|$)', 1),
                     lambda x: TRY_CAST(x AS BIGINT))) AS tnums,
                list_distinct(list_transform(
                     regexp_extract_all(coalesce(message, ''), '#(0|[1-9][0-9]*)([^0-9A-Za-z]|$)', 1),
                     lambda x: TRY_CAST(x AS BIGINT))) AS mnums
         FROM authored_),
exploded_ AS (SELECT team, commit_id, author_id, authored_at, title, lines_added, lines_removed,
                     CASE WHEN len(tnums) > 0 THEN 'title' ELSE 'message' END AS cited_in,
                     unnest(CASE WHEN len(tnums) > 0 THEN tnums ELSE mnums END) AS cited_number FROM cit_),
keys_ AS (SELECT team, o_orderkey AS card FROM orders JOIN cust_team_ ON c_custkey = o_custkey),
links_ AS (SELECT x.team, k.card, x.cited_number, CAST(k.card IS NULL AS INTEGER) AS is_dangling, x.cited_in,
                  x.commit_id, x.author_id, x.authored_at, x.title, x.lines_added, x.lines_removed
           FROM exploded_ x LEFT JOIN keys_ k ON k.team = x.team AND k.card = x.cited_number)
"""

ORACLE = {
    "explode_weighted": "WITH " + PARTS_SQL + " SELECT * FROM ex",
    "explode_roundtrip": "WITH " + PARTS_SQL + """,
        back AS (SELECT card, string_agg(label, ';' ORDER BY position) AS rejoined FROM ex GROUP BY card)
        SELECT (SELECT count(*) FROM plab WHERE labels IS NOT NULL) AS records,
               (SELECT count(*) FROM ex) AS exploded_rows,
               (SELECT round(sum(weight), 6) FROM ex) AS weight_total,
               (SELECT count(*) FROM plab p LEFT JOIN back b USING (card)
                WHERE p.labels IS NOT NULL AND b.rejoined IS DISTINCT FROM p.labels) AS mismatches""",
    "allocated_sum": "WITH " + PARTS_SQL + """
        SELECT label, count(DISTINCT card) AS cards, round(sum(comments * weight), 6) AS allocated_comments
        FROM ex JOIN plab USING (card) GROUP BY label""",
    "ref_citations": "WITH " + LINKS_SQL + " SELECT * FROM links_",
    "ref_dangling": "WITH " + LINKS_SQL + """
        SELECT team, count(DISTINCT commit_id) AS citing_commits, count(*) AS links,
               CAST(sum(is_dangling) AS BIGINT) AS dangling_links, count(DISTINCT card) AS linked_cards
        FROM links_ GROUP BY team""",
    "reconcile_pairs": "WITH " + LINKS_SQL + """,
        pieces_ AS (SELECT team, commit_id, 1 AS field, unnest(string_split(coalesce(title, ''), '#')[2:]) AS seg FROM authored_
                    UNION ALL
                    SELECT team, commit_id, 2, unnest(string_split(coalesce(message, ''), '#')[2:]) FROM authored_),
        lead_ AS (SELECT team, commit_id, field, seg, length(seg) - length(ltrim(seg, '0123456789')) AS n FROM pieces_),
        hits_ AS (SELECT DISTINCT team, commit_id, field, TRY_CAST(left(seg, n) AS BIGINT) AS cited_number FROM lead_
                  WHERE n > 0 AND (n = 1 OR left(seg, 1) <> '0')
                    AND NOT regexp_matches(substr(seg, n + 1, 1), '[0-9A-Za-z]')),
        scan_ AS (SELECT team, commit_id, cited_number FROM hits_ h WHERE cited_number IS NOT NULL
                  AND field = (SELECT min(field) FROM hits_ m WHERE m.team = h.team AND m.commit_id = h.commit_id)),
        regex_ AS (SELECT team, commit_id, cited_number FROM links_)
        SELECT (SELECT count(*) FROM regex_) AS pairs_regex, (SELECT count(*) FROM scan_) AS pairs_scan,
               (SELECT count(*) FROM (SELECT * FROM regex_ EXCEPT SELECT * FROM scan_)) AS only_in_regex,
               (SELECT count(*) FROM (SELECT * FROM scan_ EXCEPT SELECT * FROM regex_)) AS only_in_scan""",
    "missing_label": "WITH " + si.COMMITS_SQL + """,
        closed AS (SELECT * FROM cards_ WHERE state = 'closed')
        SELECT team, count(*) AS closed_cards,
               CAST(count(*) FILTER (WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) AS BIGINT)
                   AS closed_without_size
        FROM closed GROUP BY team""",
}
