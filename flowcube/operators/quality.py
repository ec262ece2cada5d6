"""Data-quality gates that return rows, not prose.

Every gate is a Spark aggregate; results share the schema
``gate string, observed string, expected string, ok boolean`` so gates from
different layers can be unioned into one report (and written as JSON).
Observed and expected values are rendered as text so counts, exact decimal
sums and dates fit one column.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcube.sources import io

#: Sums of 64-bit hashes; values and characters that a profile shows.
HASH_SUM, SAMPLES, SHOWN = "decimal(38,0)", 3, 60
#: Digits of a 16-byte hash; records, and files at most, that are looked at first for a profile's samples.
HASH_DIGITS, HEAD, FIRST_FILES = 32, 1000, 3
GATE_COLUMNS = ["gate", "observed", "expected", "ok"]


def gate_rows(one_row: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot a one-row DataFrame into gate rows.

    ``specs`` is a list of (gate name, observed column, expected column).
    """
    parts = ", ".join(
        f"'{name}', CAST(`{obs}` AS STRING), CAST(`{exp}` AS STRING)" for name, obs, exp in specs)
    rows = one_row.selectExpr(f"stack({len(specs)}, {parts}) AS (gate, observed, expected)")
    return rows.withColumn("ok", F.col("observed").eqNullSafe(F.col("expected")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def assert_gates(gates: DataFrame) -> DataFrame:
    """Fail the job (not the driver loop) when any gate is not ok."""
    return gates.withColumn(
        "ok", F.when(F.col("ok"), F.col("ok")).otherwise(
            F.raise_error(F.concat(F.lit("gate failed: "), F.col("gate")))))


def key_uniqueness(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """Rows vs distinct keys (Q2/A5).  The key tuple is a struct so NULL parts still count."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.lit(",".join(cols)).alias("key_columns"),
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(F.struct(*cols)).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def orphan_count(child: DataFrame, parent: DataFrame, name: str,
                 child_cols: list[str], parent_cols: list[str]) -> DataFrame:
    """Child rows whose foreign key has no parent (Q3), as a left anti join.

    Rows with a NULL key are not orphans (a NULL foreign key refers to nothing).
    """
    cond = [child[c] == parent[p] for c, p in zip(child_cols, parent_cols)]
    keyed = child.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_cols]))
    return (keyed.join(parent.select(*parent_cols), cond, "left_anti")
                 .agg(F.lit(name).alias("relation"), F.count(F.lit(1)).alias("orphan_rows")))


def fanout(left: DataFrame, right: DataFrame, on: str, measure: str) -> DataFrame:
    """Rows and measure sum that a many-to-many join on ``on`` would produce.

    The product is computed from per-key counts (Σ n_left(k)·n_right(k)), so
    the audit never materialises the exploded join, whatever the key skew.
    """
    lk = left.groupBy(on).agg(F.count(F.lit(1)).alias("nl"),
                              F.sum(F.col(measure).cast("decimal(18,2)")).alias("ml"))
    rk = right.groupBy(on).agg(F.count(F.lit(1)).alias("nr"))
    return (lk.join(rk, on)
              .agg(F.sum(F.col("nl") * F.col("nr")).cast("bigint").alias("join_rows"),
                   F.sum(F.col("ml") * F.col("nr")).cast("decimal(38,2)").alias("join_measure")))


def left_join_size(left: DataFrame, right: DataFrame, on: str, measure: str) -> DataFrame:
    """Rows and measure sum of the left join on ``on``: the rows of ``left`` are counted per key before they meet ``right``,
    and a key that ``right`` holds twice counts them twice."""
    per = left.groupBy(on).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(measure).cast("decimal(18,2)")).cast("decimal(38,2)").alias("m"))
    return per.join(right.select(on), on, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("join_rows"), F.sum("m").cast("decimal(38,2)").alias("join_measure"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count per column from one aggregate pass, unpivoted (Q4)."""
    cols = cols or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    parts = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, nulls)")


def fingerprint(df: DataFrame) -> DataFrame:
    """Fingerprint of a table as a multiset of rows, one scan (Q1, Q4, Q5): per column rows, nulls and the sum of its
    values' 64-bit hashes; the row of column '*' sums hashes of whole rows.

    Sums do not depend on order or partitioning and count repeated rows; equal tables have equal fingerprints, and tables that
    differ have equal ones by a chance of 2^-64 a column.
    """
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(whole.cast(HASH_SUM)).alias("h")]
    for i, c in enumerate(df.columns):
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}"), F.sum(F.xxhash64(F.col(f"`{c}`")).cast(HASH_SUM)).alias(f"h{i}")]
    rows = [F.struct(F.lit("*").alias("column_name"), F.lit(0).cast("bigint").alias("nulls"), F.col("h").alias("hash"))]
    rows += [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"), F.col(f"h{i}").alias("hash")) for i, c in enumerate(df.columns)]
    return df.agg(*aggs).select("rows", F.explode(F.array(*rows)).alias("x")).select("x.column_name", "rows", "x.nulls", "x.hash")


def round_trip(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Gates of copies against their sources (name -> source, copy): rows, nulls per column, columns and rows that differ.

    One scan a side.  Rows are only compared where fingerprints differ: both sides are then subtracted as multisets.
    """
    from flowcube.operators.materialize import materialize
    sides = []
    for name, (source, copy) in tables.items():
        s, c = (fingerprint(df).select("column_name", *[F.col(x).alias(f"{x}_{tag}") for x in ("rows", "nulls", "hash")])
                for df, tag in ((source, "s"), (copy, "c")))
        sides.append(s.join(c, "column_name", "full").withColumn("table_name", F.lit(name)))
    both = materialize(union_all(sides).withColumn("same", F.col("hash_s").eqNullSafe(F.col("hash_c")) & F.col("nulls_s").eqNullSafe(F.col("nulls_c"))))
    differ = [r.table_name for r in both.filter((F.col("column_name") == "*") & (~F.col("same") | ~F.col("rows_s").eqNullSafe(F.col("rows_c"))))
              .select("table_name").collect()]  # names of this call only

    def gate(df, name, observed, expected):
        return df.select(name.alias("gate"), observed.cast("string").alias("observed"), expected.cast("string").alias("expected"))

    cols = both.filter("column_name <> '*'")
    parts = [
        gate(both.filter("column_name = '*'"), F.concat(F.lit("rows_eq_source:"), "table_name"), F.col("rows_c"), F.col("rows_s")),
        gate(cols, F.concat(F.lit("nulls_eq_source:"), "table_name", F.lit("."), "column_name"), F.col("nulls_c"), F.col("nulls_s")),
        gate(cols.groupBy("table_name").agg(F.count_if(~F.col("same")).alias("n")), F.concat(F.lit("columns_that_differ:"), "table_name"),
             F.col("n"), F.lit(0))]
    for name, (source, copy) in tables.items():
        if name in differ:
            n = symmetric_difference(source, copy).agg(F.count(F.lit(1)).alias("n"))
            parts.append(gate(n, F.lit(f"rows_that_differ:{name}"), F.col("n"), F.lit(0)))
    equal = both.filter("column_name = '*'").filter(~F.col("table_name").isin(differ)) if differ else both.filter("column_name = '*'")
    parts.append(gate(equal, F.concat(F.lit("rows_that_differ:"), "table_name"), F.lit(0), F.lit(0)))
    return union_all(parts).withColumn("ok", F.col("observed").eqNullSafe(F.col("expected")))


def observed_class(c: str, dtype: str) -> F.Column:
    """Class of one value by its content: 0 integer, 1 real, 2 date, 3 date and time, 4 text, 5 array; the column's is the widest."""
    v = F.col(f"`{c}`")
    if dtype.startswith("array"):
        return F.lit(5)
    if dtype in ("float", "double") or dtype.startswith("decimal"):
        return F.when(v == F.floor(v), 0).otherwise(1)
    if dtype.startswith("timestamp"):
        return F.when(v == F.date_trunc("DAY", v), 2).otherwise(3)
    if dtype == "date":
        return F.lit(2)
    if dtype == "string":
        return (F.when((v < "-") | (v >= ":"), 4)  # no pattern begins with another character than a minus or a digit
                 .when(v.rlike(io.RE_INT), 0).when(v.rlike(io.RE_REAL), 1).when(v.rlike(io.RE_DATE), 2)
                 .when(v.rlike(io.RE_TIMESTAMP), 3).otherwise(4))
    return F.lit(0)


def is_nested(dtype: str) -> bool:
    return dtype.startswith(("array", "map", "struct"))


def is_float(dtype: str) -> bool:
    return dtype in ("float", "double")


def _shown(c: str) -> F.Column:
    return F.substring(F.col(f"`{c}`").cast("string"), 1, SHOWN)


def distinct_key(c: str, dtype: str) -> F.Column:
    """What tells the values of a column apart: numbers, dates, times and texts of up to SHOWN bytes by themselves; a longer text by
    the 32 digits of its 16-byte hash, its class and the characters shown, which are more bytes; an array by the hash of its JSON."""
    v = F.col(f"`{c}`")
    if is_nested(dtype):
        return F.when(v.isNotNull(), F.md5(F.to_json(F.struct(v.alias("v"))).cast("binary")))
    if dtype == "string":
        long = F.concat(F.md5(v.cast("binary")), observed_class(c, dtype).cast("string"), F.substring(v, 1, SHOWN))
        return F.when(F.octet_length(v) <= SHOWN, v).otherwise(long)
    return v


def distinct_values(df: DataFrame, c: str, dtype: str) -> DataFrame:
    """One row for a column: distinct values, their classes as bits, and least and greatest value (not for floats: a key has no -0.0).

    The scan reads this column alone, and its keys are combined before the shuffle: no long text and no array travels.  What
    depends on the value alone is taken from the distinct ones.
    """
    keys = df.select(distinct_key(c, dtype).alias("k")).filter(F.col("k").isNotNull()).distinct()
    k, cls = F.col("k"), observed_class("k", dtype)
    if dtype == "string":
        short = F.octet_length(k) <= SHOWN
        cls = F.when(short, cls).otherwise(F.substring(k, HASH_DIGITS + 1, 1).cast("int"))
        k = F.when(short, k).otherwise(F.substring(k, HASH_DIGITS + 2, SHOWN))
    low, high = (F.lit(None), F.lit(None)) if is_nested(dtype) or is_float(dtype) else (F.min(k), F.max(k))
    return keys.agg(F.count(F.lit(1)).alias("distinct_values"), F.bit_or(F.call_function("shiftleft", F.lit(1), cls)).alias("classes"),
                    low.cast("string").alias("min_value"), high.cast("string").alias("max_value"))


def row_values(df: DataFrame) -> DataFrame:
    """A row for each column from one aggregate over the table: rows, nulls and the bounds of floats."""
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, (c, d) in enumerate(df.dtypes):
        v, low, high = F.col(f"`{c}`"), F.lit(None), F.lit(None)
        aggs.append(F.count(v).alias(f"n{i}"))
        if is_float(d):
            aggs += [F.min(v).cast("string").alias(f"low{i}"), F.max(v).cast("string").alias(f"high{i}")]
            low, high = F.col(f"low{i}"), F.col(f"high{i}")
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(d).alias("type_name"),
                             (F.col("rows") - F.col(f"n{i}")).alias("nulls"), low.cast("string").alias("low"), high.cast("string").alias("high")))
    return df.agg(*aggs).select("rows", F.explode(F.array(*rows)).alias("x")).select("rows", "x.*")


def _sample(c: str, dtype: str) -> F.Column:
    """A value as (key, shown); keys are texts that the driver can hold."""
    v = F.col(f"`{c}`")
    if is_float(dtype):
        key = (v + F.lit(0).cast(dtype)).cast("string")  # -0.0 and 0.0 are one value
    elif dtype == "timestamp":
        key = F.unix_micros(v).cast("string")
    else:
        key = F.hex(v) if dtype == "binary" else distinct_key(c, dtype).cast("string")
    return F.struct(key.alias("key"), _shown(c).alias("shown"))


def _is_none_of(c: str, dtype: str, keys: list[str]) -> F.Column:
    """Whether a value is none of those with these keys of ``_sample``; null for null."""
    made = {"timestamp": lambda k: F.timestamp_micros(k.cast("bigint")), "binary": F.unhex}.get(dtype, lambda k: k.cast(dtype))
    return ~distinct_key(c, dtype).isin([made(F.lit(k)) for k in keys]) if keys else F.col(f"`{c}`").isNotNull()


def first_values(df: DataFrame, wanted: dict[str, int]) -> dict[str, list[str]]:
    """The first distinct values in file order of each column of ``wanted`` (column -> how many, at most its distinct values).

    The HEAD records that begin the first file are looked at first.  A column that repeats itself there is scanned as a whole, for
    the value at the least place that is none of those found, until it has as many as are wanted.
    """
    dtypes = dict(df.dtypes)
    late = [c for c, n in wanted.items() if n]
    found: dict[str, dict[str, str]] = {c: {} for c in late}  # key -> shown, in order
    row = F.col("_metadata.row_index")
    paths = sorted(re.sub("^file:/+", "file:/", p) for p in df.inputFiles()) if late else []  # as in _metadata
    for path in paths[:FIRST_FILES]:
        head = df.filter((F.col("_metadata.file_path") == path) & (row < HEAD)).select(
            row.alias("__row"), *[F.when(F.col(f"`{c}`").isNotNull(), _sample(c, dtypes[c])).alias(f"v{i}") for i, c in enumerate(late)])
        records = sorted(head.limit(HEAD).collect(), key=lambda r: r["__row"])  # the limit cuts nothing, it ends the reading
        for r in records:
            for i, c in enumerate(late):
                if r[f"v{i}"] is not None and len(found[c]) < wanted[c]:
                    found[c].setdefault(*r[f"v{i}"])
        if records:
            break
    placed = None
    while late := [c for c in late if len(found[c]) < wanted[c]]:
        placed = placed or io.placed_records(df, "__at")
        aggs = []
        for i, c in enumerate(late):
            new = _is_none_of(c, dtypes[c], list(found[c]))
            aggs.append(F.min_by(_sample(c, dtypes[c]), F.when(new, F.col("__at"))).alias(f"v{i}"))
        r = placed.agg(*aggs).first()
        for i, c in enumerate(late):
            if r[f"v{i}"] is None or r[f"v{i}"]["key"] in found[c]:
                raise ValueError(f"column {c}: {wanted[c]} values were counted, {len(found[c])} found")
            found[c].setdefault(*r[f"v{i}"])
    return {c: list(x.values()) for c, x in found.items()}


def column_profile(df: DataFrame, name: str) -> DataFrame:
    """Per column: declared and observed type, rows, nulls, distinct values, least and greatest value and the first
    SAMPLES distinct values in file order (S18); values are shown by their first SHOWN characters.

    The columns of a table are counted side by side, in one job, whose result has a row a column.  Arrays have no order and no samples.
    """
    import pyarrow as pa

    from flowcube.operators.materialize import materialize
    values = union_all([distinct_values(df, c, d).withColumn("position", F.lit(i)) for i, (c, d) in enumerate(df.dtypes)])
    per = materialize(row_values(df).join(values, "position", "left"))
    some = per.filter(F.col("distinct_values") > 0).select("column_name", "type_name", "distinct_values").collect()  # of one table
    found = first_values(df, {r["column_name"]: min(SAMPLES, r["distinct_values"]) for r in some if not is_nested(r["type_name"])})
    samples = pa.table([pa.array(list(found), pa.string()), pa.array([" | ".join(v) for v in found.values()], pa.string())], names=["column_name", "samples"])
    has = lambda *cs: F.col("classes").bitwiseAND(F.lit(~sum(1 << c for c in cs))) == 0
    observed = (F.when(F.col("classes").isNull(), "TEXT").when(has(0), "INTEGER").when(has(0, 1), "REAL").when(has(2), "DATE")
                 .when(has(2, 3), "DATETIME").when(has(5), "ARRAY").otherwise("TEXT"))
    return per.join(F.broadcast(df.sparkSession.createDataFrame(samples)), "column_name", "left").select(
        F.lit(name).alias("table_name"), "position", "column_name", "type_name", observed.alias("observed_type"), "rows", "nulls",
        "distinct_values", F.coalesce("min_value", "low").alias("min_value"), F.coalesce("max_value", "high").alias("max_value"), "samples")


def symmetric_difference(a: DataFrame, b: DataFrame, label_a: str = "a", label_b: str = "b") -> DataFrame:
    """Rows present on one side only, with multiplicity (U3/Q5), tagged by side."""
    return (a.exceptAll(b).withColumn("only_in", F.lit(label_a))
             .unionByName(b.exceptAll(a).withColumn("only_in", F.lit(label_b))))


def rule_violations(df: DataFrame, rules: dict[str, F.Column]) -> DataFrame:
    """Count rows breaking each rule (Q16): ``rules`` maps name -> predicate that must hold."""
    one = df.agg(*[F.count_if(~F.coalesce(pred, F.lit(False))).alias(n) for n, pred in rules.items()])
    parts = ", ".join(f"'{n}', `{n}`" for n in rules)
    return (one.selectExpr(f"stack({len(rules)}, {parts}) AS (rule, violations)")
               .withColumn("ok", F.col("violations") == 0))
