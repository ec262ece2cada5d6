"""Secret scan: fixed base patterns plus a randomness test battery over long tokens.

Base kinds (leftmost, non-overlapping per kind; a match that fails its length
rule is dropped and not retried): ``assign``, ``access``, ``hex``.

The method adds kind ``random``.  A candidate is a run of 20 or more characters
of the usual encodings.  Its encoding is the smallest listed alphabet (size k)
that holds it; a run that none holds ('/' or '+' beside '-' or '_', as in a URL path) is cut at '/' and '+', and its parts
of 20 or more characters are candidates, with their own positions.  Three tests look for departures from independent uniform symbols:
  * chi-squared of symbol counts (mean k-1, exact multinomial variance),
  * Wald-Wolfowitz runs above and below the middle of the alphabet,
  * lag-1 serial correlation of symbol indices.
Their p-values are combined by Fisher's method (closed form for three tests).
A token that the battery does not reject is then tested against ordinary text:
the likelihood ratio of uniform symbols to a chain of ordinary bigrams, restricted to the
encoding's alphabet.  The chain is counted over the words of all documents that are too short to be candidates.
If a token is ordinary, its ratio exceeds t with probability at most 1/t (Markov), so 1/ratio is a
p-value; a random token of 20 characters has a small one in a class of ordinary tokens.
The p-values go through Benjamini-Hochberg within each (encoding, length class).
Decimal tokens are tested but not reported: digits of ordinary numbers (amounts, ids, times) are near
uniform themselves, so no test on symbols tells them from random digits.
Thresholds come from a histogram of p-values per class (a few hundred bins per
class, whatever the corpus size).
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowcube.llm.common import documents, let
from flowcube.operators.materialize import materialize

WORD = "(?i:password|passwd|secret|token|api_?key)"
#: Kinds in listed order: pattern, group whose length counts, least length.
PATTERNS = {
    "assign": (WORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # a run under 32 holds no match, so nothing is retried
    "random": (r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
}
KINDS = list(PATTERNS)
#: A part of a run that fits no alphabet.
PART = r"[A-Za-z0-9_-]+={0,2}"
#: Encoding: pattern of the whole token and its alphabet, smallest first.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "decimal": ("[0-9]+", DIGITS),
    "hex": ("[0-9a-f]+", DIGITS + "abcdef"),
    "hex_upper": ("[0-9A-F]+", DIGITS + "ABCDEF"),
    "lower": ("[a-z]+", LOWER),
    "upper": ("[A-Z]+", LOWER.upper()),
    "base32": ("[A-Z2-7]+", LOWER.upper() + "234567"),
    "base36": ("[a-z0-9]+", DIGITS + LOWER),
    "alnum": ("[A-Za-z0-9]+", DIGITS + LOWER.upper() + LOWER),
    "base64": ("[A-Za-z0-9+/]+", LOWER.upper() + LOWER + DIGITS + "+/"),
    "base64url": ("[A-Za-z0-9_-]+", LOWER.upper() + LOWER + DIGITS + "-_"),
}
#: Battery: a token is taken as non-random below this combined p-value.
REJECT = 0.001
#: Benjamini-Hochberg level.
FDR = 0.05
#: All symbols of candidates; characters of an ordinary word; weight of symbol frequencies in a bigram's.
SYMBOLS, WORD_CHARS, BACKOFF = DIGITS + LOWER.upper() + LOWER + "+/-_", (2, 19), 5.0
BINS = 400


def matches(text: Column, kind: str) -> Column:
    """Array of (kind, nth, skip, len, ok, token): ``skip`` is the gap before the match."""
    pattern, group, least = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    if group:
        kept = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.transform(F.arrays_zip(found.alias("m"), kept.alias("g"), F.slice(gaps, 1, F.size(found)).alias("s")),
                           lambda x, n: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), n.alias("nth"), F.length(x["s"]).alias("skip"),
            F.length(x["m"]).alias("len"), (F.length(x["g"]) >= least).alias("ok"), F.lit(None).cast("string").alias("token")))
    if kind == "random":
        return candidates(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("s")))
    return F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("s")), lambda x, n: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), n.alias("nth"), F.length(x["s"]).alias("skip"),
        F.length(x["m"]).alias("len"), (F.length(x["m"]) >= least).alias("ok"), F.lit(None).cast("string").alias("token")))


def candidates(runs: Column) -> Column:
    """The array of ``matches`` for the runs (m, after the gap s): a run that fits an alphabet, or the parts of one that fits none.

    Parts are consecutive: what is between them is the next part's gap, what follows the last one is a match of no length.
    """
    def piece(skip, token, least):
        return F.struct(skip.alias("skip"), F.length(token).alias("len"), (F.length(token) >= least).alias("ok"), token.alias("token"))

    def parts(x):
        found = F.regexp_extract_all(x["m"], F.lit(PART), F.lit(0))
        gaps = F.split(x["m"], PART, -1)  # one more than parts: a gap before each, and the rest
        return F.transform(F.concat(found, F.array(F.lit(""))), lambda t, i: piece(
            F.length(F.get(gaps, i)) + F.when(i == 0, F.length(x["s"])).otherwise(0), t, PATTERNS["random"][2]))

    mixed = lambda x: x["m"].rlike("[/+]") & x["m"].rlike("[-_]")
    pieces = F.flatten(F.transform(runs, lambda x: F.when(mixed(x), parts(x)).otherwise(
        F.array(piece(F.length(x["s"]), x["m"], PATTERNS["random"][2])))))
    return F.transform(pieces, lambda p, n: F.struct(
        F.lit(KINDS.index("random")).alias("kind"), n.alias("nth"), p["skip"].alias("skip"), p["len"].alias("len"), p["ok"].alias("ok"),
        F.when(p["ok"], p["token"]).alias("token")))


def ordinary(docs: DataFrame) -> dict[str, int]:
    """Occurrences of symbols and bigrams in words of all documents; the driver receives at most 66 + 66 * 66 counts."""
    words = docs.select(F.explode(F.split("text", "[^A-Za-z0-9+/_-]+")).alias("w"))
    words = words.filter(F.length("w").between(*WORD_CHARS)).groupBy("w").agg(F.count(F.lit(1)).alias("c"))
    grams = F.concat(F.split("w", ""), F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2))))
    rows = words.select(F.explode(grams).alias("g"), "c").filter("g <> ''").groupBy("g").agg(F.sum("c").alias("c")).collect()
    return {r["g"]: r["c"] for r in rows}


def ratios(counts: dict[str, int]) -> dict[str, list[float]]:
    """Per encoding, log of uniform over ordinary probability: of a first symbol, then of every symbol after every symbol.

    Probabilities of a bigram are counts with BACKOFF occurrences dealt by the symbols' frequencies (each seen once more).
    """
    out = {}
    for name, (_, letters) in ENCODINGS.items():
        k = len(letters)
        total = sum(counts.get(c, 0) + 1 for c in letters)
        one = [(counts.get(c, 0) + 1) / total for c in letters]
        logs = [-log(k * p) for p in one]
        for before in letters:
            seen = [counts.get(before + c, 0) for c in letters]
            logs += [-log(k * (n + BACKOFF * p) / (sum(seen) + BACKOFF)) for n, p in zip(seen, one)]
        out[name] = logs
    return out


def located(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (row, keep..., kind, begin, end, battery columns): one per match, one with null kind for a document without."""
    text = F.coalesce(F.col("text"), F.lit(""))
    logs = ratios(ordinary(docs))
    rows = docs.withColumn("row", F.monotonically_increasing_id()).select(
        "row", *keep, F.concat(*[matches(text, k) for k in KINDS]).alias("found"))
    flat = rows.select("row", *keep, F.explode_outer("found").alias("x")).select("row", *keep, "x.*")
    # tokens are tested where they are found, by as many tasks as read the documents
    flat = battery(flat, logs)
    reach = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    flat = flat.withColumn("end", F.sum(F.col("skip") + F.col("len")).over(reach))
    flat = flat.withColumn("begin", F.col("end") - F.col("len"))
    return flat.filter("kind is null or ok or nth = 0").select(
        "row", *keep, F.when(F.col("ok"), F.col("kind")).alias("kind"), "begin", "end", "enc", "n", "ratio", "p_random")


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by the rational approximation of Abramowitz and Stegun 26.2.17."""
    def tail(t_z):
        t, a = t_z["t"], t_z["a"]
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return let(F.exp(-a * a / 2) * 0.3989422804014327 * poly, lambda p: F.when(t_z["z"] >= 0, p).otherwise(1 - p))
    return let(z, lambda v: let(F.struct(v.alias("z"), F.abs(v).alias("a"), (1 / (1 + 0.2316419 * F.abs(v))).alias("t")),
                                tail))


def battery(tokens: DataFrame, logs: dict[str, list[float]]) -> DataFrame:
    """Add enc, k, n, ratio (log of uniform over ordinary likelihood) and p_random; null where ``token`` is null or of no encoding."""
    body = F.rtrim(F.translate("token", "=", " "))
    code = F.lit(None).cast("struct<enc: string, k: int, alphabet: string>")
    for name, (pattern, letters) in reversed(ENCODINGS.items()):
        code = F.when(F.col("body").rlike(f"^{pattern}$"), F.struct(
            F.lit(name).alias("enc"), F.lit(len(letters)).alias("k"), F.lit(letters).alias("alphabet"))).otherwise(code)
    t = tokens.withColumn("body", body).withColumn("code", code).select("*", "code.enc", "code.k", "code.alphabet").drop("code")
    t = t.withColumn("n", F.when(F.col("enc").isNotNull(), F.length("body").cast("double")))
    # symbol indices 0..k-1 of the token, in order; null, and with it all that follows, where nothing is tested
    t = t.withColumn("ix", F.expr("case when enc is not null and length(body) > 1 then transform(split(body, ''), c -> instr(alphabet, c) - 1) end"))
    t = t.withColumn("ix", F.expr("filter(ix, i -> i >= 0)"))
    t = t.withColumn("squares", F.expr(
        "aggregate(transform(sequence(0, k - 1), s -> size(filter(ix, i -> i = s))), 0D, (a, c) -> a + 1D * c * c)"))
    # literal table of all encodings, one after the other (folded into an array once)
    table = F.split(F.lit(" ".join(f"{x:.6f}" for name in ENCODINGS for x in logs[name])), " ").cast("array<double>")
    starts, at = [], 0
    for name in ENCODINGS:
        starts += [F.lit(name), F.lit(at)]
        at += len(logs[name])
    t = t.withColumn("base", F.create_map(*starts)[F.col("enc")])
    t = t.withColumn("ratio", F.aggregate(
        F.sequence(F.lit(1), F.size("ix") - 1), F.get(table, F.col("base") + F.get("ix", F.lit(0))),
        lambda a, j: a + F.get(table, F.col("base") + F.col("k") * (F.get("ix", j - 1) + 1) + F.get("ix", j))))
    chi = F.expr("(k * squares / n - n - (k - 1)) / sqrt(2D * (k - 1) * (n - 1) / n)")
    t = t.withColumn("high", F.expr("1D * size(filter(ix, i -> 2 * i >= k))")).withColumn("low", F.expr("n - high"))
    t = t.withColumn("runs", F.expr(
        "1D + size(filter(sequence(1, size(ix) - 1), j -> (2 * get(ix, j) >= k) <> (2 * get(ix, j - 1) >= k)))"))
    t = t.withColumn("rv", F.expr("2D * high * low * (2D * high * low - n) / (n * n * (n - 1))"))
    runs = F.expr("case when rv > 0 then (runs - (2D * high * low / n + 1)) / sqrt(rv) else 9D end")
    t = t.withColumn("lag", F.expr(
        "aggregate(sequence(1, size(ix) - 1), 0D, (a, j) -> a + (get(ix, j) - (k - 1) / 2D) * (get(ix, j - 1) - (k - 1) / 2D))"))
    serial = F.expr("lag / (sqrt(n - 1) * (k * k - 1) / 12D)")
    tests = [upper_tail(chi), 2 * upper_tail(F.abs(runs)), 2 * upper_tail(F.abs(serial))]
    fisher = sum((-F.log(F.greatest(p, F.lit(1e-300))) for p in tests), F.lit(0.0))
    t = t.withColumn("fisher", fisher)
    t = t.withColumn("p_random", F.expr("exp(-fisher) * (1 + fisher + fisher * fisher / 2)"))
    return t.drop("token", "body", "alphabet", "base", "ix", "squares", "high", "low", "runs", "rv", "lag", "fisher")


def discoveries(tested: DataFrame) -> DataFrame:
    """Keep tokens of ``battery`` that look random, under false-discovery control per length class."""
    t = tested.filter("enc is not null").withColumn("size_class", F.floor(2 * F.log2("n")).cast("int"))
    t = t.withColumn("p_plain", F.exp(-F.greatest("ratio", F.lit(0.0))))
    t = t.withColumn("p_plain", F.when(F.col("p_random") < REJECT, F.lit(1.0)).otherwise(F.col("p_plain")))
    # histogram bins of -log10 p; a bin stands for its largest p, which errs on the strict side
    t = t.withColumn("bin", F.least(F.floor(-F.log10(F.greatest("p_plain", F.lit(1e-40))) * 10), F.lit(BINS - 1)).cast("int"))
    t = t.filter("enc <> 'decimal'")  # see above
    bins = t.groupBy("enc", "size_class", "bin").agg(F.count(F.lit(1)).alias("c"))
    cls = Window.partitionBy("enc", "size_class")
    better = cls.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("found", F.sum("c").over(better)).withColumn("m", F.sum("c").over(cls))
    cut = bins.filter(F.expr(f"m * pow(10D, -bin / 10D) <= {FDR} * found")).groupBy("enc", "size_class").agg(
        F.min("bin").alias("cut"))
    return t.join(F.broadcast(cut), ["enc", "size_class"]).filter("bin >= cut")


def find_secrets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Per row of ``docs``: ``keep`` columns and ``spans``, an array of (begin, kind, end) in order.

    ``kind`` is the index in KINDS; positions count code points, the end is exclusive.  Null text is
    empty; repeated rows are scanned one by one; an empty table gives an empty result.  ``keep``
    must not contain the names row, kind, begin, end, token, nth, skip, len, ok or those of the battery.
    """
    found = materialize(located(docs, keep))
    random = KINDS.index("random")
    hits = discoveries(found.filter(F.col("kind") == random).select("row", "begin", "end", "enc", "n", "ratio", "p_random"))
    hits = hits.select("row", "begin", "end", F.lit(True).alias("hit"))
    spans = found.join(hits, ["row", "begin", "end"], "left")
    span = F.when(F.col("kind").isNotNull() & ((F.col("kind") != random) | F.col("hit")),
                  F.struct(F.col("begin").alias("begin"), F.col("kind").alias("kind"), F.col("end").alias("end")))
    firsts = [F.first(c).alias(c) for c in keep]
    return spans.groupBy("row").agg(*firsts, F.array_sort(F.collect_list(span)).alias("spans")).drop("row")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` comma-joined, by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(names, s["kind"]), F.lit(":"), s["begin"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; n_chars follows the text where present.

    Overlapping spans are merged first.  Rows, and columns of any other name, stay as they are.
    """
    fields = docs.columns
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    # spans depend on the text alone: they are found without carrying the documents along and meet them by its hash
    found = find_secrets(docs.select("text").withColumn("digest", digest), ["digest"]).filter(F.size("spans") > 0).dropDuplicates(["digest"])
    merged = F.aggregate(
        "spans", F.expr("cast(array() as array<struct<begin: bigint, end: bigint>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["begin"] <= F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(-1))),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.try_element_at(acc, F.lit(-1))["begin"].alias("begin"),
                F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end"))))))
    found = found.select(F.col("digest").alias("f_digest"), merged.alias("cuts"))
    out = docs.select(F.struct(*fields).alias("__doc"), digest.alias("d_digest"))
    out = out.join(found, F.col("d_digest") == F.col("f_digest"), "left").withColumn(
        "cuts", F.coalesce("cuts", F.expr("cast(array() as array<struct<begin: bigint, end: bigint>>)")))
    out = out.withColumn("text", F.col("__doc.text"))
    # kept pieces lie between one cut's end and the next cut's begin
    pieces = F.expr("transform(sequence(0, size(cuts)), i -> substring(text, int(if(i = 0, 0, cuts[i - 1].end)) + 1, "
                    "int(if(i = size(cuts), length(text), cuts[i].begin) - if(i = 0, 0, cuts[i - 1].end))))")
    clean = F.when(F.size("cuts") == 0, F.col("text")).otherwise(F.array_join(pieces, mask))
    out = out.withColumn("__clean", clean)
    cols = []
    for c in fields:
        if c == "text":
            cols.append(F.col("__clean").alias("text"))
        elif c == "n_chars":
            cols.append(F.when(F.size("cuts") > 0, F.length("__clean").cast(docs.schema["n_chars"].dataType))
                        .otherwise(F.col("__doc.n_chars")).alias(c))
        else:
            cols.append(F.col("__doc").getField(c).alias(c))
    return out.select(*cols)


def op10_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    out = find_secrets(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return out.select("doc_id", *counts, F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
                      span_text(F.col("spans")).alias("spans"))


QUERIES = {"op10_secret_battery": op10_secret_battery}
ORACLE: dict[str, str] = {}
