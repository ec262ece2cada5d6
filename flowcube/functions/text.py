"""Text and list functions (F1-F7, F15, F16, R1, R2) as Spark column expressions.

All of them are JVM built-ins (``split``, ``posexplode``,
``regexp_extract_all``, ``transform``), so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a citation is '#' + a number without leading zero that is not
# followed by a letter or digit ("#12)" and "#12 " count; "#12abc", "#007" do not).
CITATION_RE = r"#(0|[1-9][0-9]*)(?![0-9A-Za-z])"


def explode_weighted(df: DataFrame, keys: list[str], col: str, sep: str = ";",
                     value_name: str = "value") -> DataFrame:
    """One row per (record, value) with 1-based position, value count and weight 1/n.

    Empty parts are kept (``'a;;b'`` has three values), a NULL field gives no row.
    Summing ``weight`` over the exploded rows of a record gives exactly 1, so
    sums over the explosion never count a record twice (D6 bridges).
    """
    parts = F.split(F.col(col), re.escape(sep))
    base = df.filter(F.col(col).isNotNull()).select(*keys, parts.alias("__parts"))
    return (base.select(*keys, F.size("__parts").alias("n_values"),
                        F.posexplode("__parts").alias("__pos", value_name))
                .select(*keys, (F.col("__pos") + 1).alias("position"), value_name, "n_values",
                        (F.lit(1.0) / F.col("n_values")).alias("weight")))


def rejoin_parts(exploded: DataFrame, keys: list[str], value_name: str = "value", sep: str = ";") -> DataFrame:
    """Inverse of :func:`explode_weighted` (F16): values re-joined in position order.

    The list per record is bounded by the record's own field, so gathering it
    in one group is safe.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", value_name)))
    return (exploded.groupBy(*keys)
                    .agg(F.array_join(F.transform(ordered, lambda x: x[value_name]), sep).alias("rejoined")))


def citations(text: F.Column) -> F.Column:
    """Distinct cited numbers in ``text`` as array<bigint>."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CITATION_RE), 1)
    numbers = F.transform(found, lambda x: x.try_cast("bigint"))  # no card has a number beyond 64 bits
    return F.array_distinct(F.filter(numbers, lambda x: x.isNotNull()))


def citations_with_fallback(primary: F.Column, fallback: F.Column) -> tuple[F.Column, F.Column]:
    """Citations of ``primary``; those of ``fallback`` only when ``primary`` has none (R2).

    Returns (numbers array, source label column).
    """
    p, f = citations(primary), citations(fallback)
    use_primary = F.size(p) > 0
    return (F.when(use_primary, p).otherwise(f),
            F.when(use_primary, F.lit("title")).otherwise(F.lit("message")))


# Size aliases -> canonical size label, and the category names.
SIZE_ALIASES = {
    "SIZE_PP": ["SIZE_PP", "SIZE PP", "PP"],
    "SIZE_P": ["SIZE_P", "SIZE P", "P"],
    "SIZE_M": ["SIZE_M", "SIZE M", "M"],
    "SIZE_G": ["SIZE_G", "SIZE G", "G"],
    "SIZE_GG": ["SIZE_GG", "SIZE GG", "GG"],
}
BUG_ALIASES = ["BUG", "FIX"]
PRIORITY_LABELS = ["P1", "P2", "P3", "P4", "P5", "P6", "P7", "P8"]
META_PREFIXES = ["ANO:", "CURSO:", "TRIMESTRE:"]
ARTIFACT_RANGE = (1, 18)


def canonical_label(raw: F.Column) -> F.Column:
    """Canonical label (F7): ``ART n`` -> ``ART-nn`` for n in 1..18, size and bug aliases
    folded, anything else upper-cased and trimmed (Unicode upper, see T6)."""
    norm = F.upper(F.trim(raw))
    digits = F.regexp_replace(F.regexp_replace(F.regexp_replace(norm, "ART", ""), r"\.", ""), " ", "")
    lo, hi = ARTIFACT_RANGE
    is_art = (norm.startswith("ART") & (digits != "") & digits.rlike(r"^[0-9]+$")
              & digits.try_cast("decimal(38,0)").between(lo, hi))
    out = F.when(is_art, F.format_string("ART-%02d", digits.cast("int")))
    for canon, aliases in SIZE_ALIASES.items():
        out = out.when(norm.isin(*aliases), F.lit(canon))
    return out.when(norm.isin(*BUG_ALIASES), F.lit("BUG")).otherwise(norm)


def label_category(canon: F.Column) -> F.Column:
    """Category of a canonical label."""
    meta = None
    for p in META_PREFIXES:
        cond = canon.startswith(p)
        meta = cond if meta is None else (meta | cond)
    return (F.when(canon.startswith("ART-"), "ARTEFATO")
             .when(canon.isin(*SIZE_ALIASES.keys()), "TAMANHO")
             .when(canon.isin(*PRIORITY_LABELS), "PRIORIDADE")
             .when(canon == "BUG", "BUG")
             .when(meta, "METADADO_TURMA")
             .otherwise("TIPO_TRABALHO"))


# Fixed value: substrings that mark an automated actor.
BOT_MARKERS = ["bot", "automat", "automation", "pipeline", "runner"]


def is_bot(person: F.Column) -> F.Column:
    p = F.lower(F.coalesce(person, F.lit("")))
    cond = None
    for m in BOT_MARKERS:
        c = F.instr(p, m) > 0
        cond = c if cond is None else (cond | c)
    return cond.cast("int")
