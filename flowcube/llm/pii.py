"""Personal data in text, plain and disguised, with spans in the source text.

Base kinds are matched in the source as it stands (leftmost, non-overlapping
per kind; a match that fails its rule is dropped and not retried).

Disguised ones are found by deobfuscation.  A chain of small transducers
rewrites the text while an alignment maps every output character to the
source span it came from:
  * homoglyphs and full-width forms become ASCII, zero-width characters vanish;
  * spelled digits (``four``, ``cinq``, ``oh``, ``double five`` in a run of four or more) become digits, ``plus`` before them ``+``;
  * ``[at]``, ``(dot)``, ``{punkt}`` and, between words of an address, plain ``at`` and ``dot`` and their like
    become ``@`` and ``.`` with the spaces around them, also in the local part of such an address.
Words are those of English, German, French and Spanish.
The same detectors run on the rewritten text; a hit is mapped back through the
alignment, and is added if its source span holds a rewritten character and
overlaps no base span of its kind but such as it contains.  Every pass is linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcube.llm.common import documents

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Look-alike letters and the ASCII letters they stand for, by script.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "А": "A", "В": "B",
    "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i",
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "ı": "i", "\u2024": ".",
    "\u3002": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u00a0": " ", "\u202f": " ",
}
LOOKALIKES |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}  # full-width forms
LOOKALIKES |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}  # mathematical digits
#: Zero-width and soft characters.
VANISH = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
# The digits from zero to nine, by language, and further forms.
DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
SPELLED = {w: str(i) for words in DIGIT_WORDS.values() for i, w in enumerate(words.split())}
SPELLED |= {"oh": "0", "zwo": "2", "fuenf": "5", "une": "1"}
TIMES = {"double": 2, "triple": 3, "doppel": 2, "doble": 2}
PLUS = {"plus", "más", "mas"}
# Words for '@' and '.'; the second lists are common words otherwise and count in brackets, or beside a sure word.
AT_WORDS, AT_IN_BRACKETS = {"at", "ät", "arroba", "arobase", "klammeraffe"}, {"chez", "bei"}
DOT_WORDS, DOT_BESIDE = {"dot", "punkt", "punto"}, {"point"}

LOOKS = re.compile("[" + re.escape("".join(LOOKALIKES)) + VANISH + "]")


def any_of(*words: set[str]) -> str:
    return "(?:" + "|".join(sorted(set().union(*words), key=len, reverse=True)) + ")"


# four or more spelled digits in a row, or among digits; blanks and hyphens between them go with the words
NUMBER = any_of(set(SPELLED))
UNIT = rf"(?:{any_of(set(TIMES))}[ -])?(?:{NUMBER}|[0-9])"
SPELLED_RUN = re.compile(rf"(?<![^\W_])(?:{any_of(PLUS)}[ -])?{UNIT}(?:[ -]{{1,2}}{UNIT}(?![^\W\d_])){{3,}}(?![^\W\d_])", re.I)
SPELLED_ONE = re.compile(rf"(?P<plus>{any_of(PLUS)})|(?:(?P<times>{any_of(set(TIMES))})[ -])?(?P<digit>{NUMBER}|[0-9])|[ -]+", re.I)
DOTS = any_of(DOT_WORDS, DOT_BESIDE)
BRACKETED = re.compile(rf"\s?[\[({{<]\s?({any_of(AT_WORDS, AT_IN_BRACKETS)}|{DOTS})\s?[\])}}>]\s?", re.I)
SPOKEN_AT = re.compile(rf" ({any_of(AT_WORDS)}) ", re.I)
SPOKEN_DOT = re.compile(rf" {DOTS} ", re.I)
LABEL = "[A-Za-z0-9-]++"


def spoken_domain(dots: str) -> str:
    return rf"{LABEL}(?: {dots} (?!{dots}\b){LABEL})++(?!\w)"


#: After "at", the word "point" is no dot ("look at this point of view"); after the others it is.
DOMAIN_AFTER_AT = re.compile(spoken_domain(any_of(DOT_WORDS)), re.I)
DOMAIN_AFTER_SURE = re.compile(spoken_domain(DOTS), re.I)
SPOKEN_TAIL = re.compile(rf"(?<=@){LABEL}(?:(?: {DOTS} (?!{DOTS}\b)|\.){LABEL})++", re.I)
#: Spoken dots at the end of a local part, looked for in the last characters before a disguised '@'.
LOCAL_DOTS, LOCAL_REACH = re.compile(rf"(?<![\w.])[A-Za-z0-9_%+-]+(?: {DOTS} (?!{DOTS}\b)[A-Za-z0-9._%+-]+)+\Z", re.I), 96


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def local_begin(text: str, at: int, free: int) -> int:
    """Where the local part that ends before ``at`` begins, not before ``free``; ``at`` if there is none."""
    begin = at
    while begin > free:
        step = max(free, begin - 64)
        tail = LOCAL_END.search(text, step, begin)
        if not tail:
            break
        begin = tail.start()
        if begin > step:
            break
    return begin


def emails(text: str) -> list[tuple[int, int]]:
    """Anchored at '@': the local part reaches left to the last other character or the previous match."""
    out, free = [], 0
    for m in DOMAIN.finditer(text):
        begin = local_begin(text, m.start(), free)
        if begin < m.start():
            out.append((begin, m.end()))
            free = m.end()
    return out


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four kinds, sorted."""
    out = []
    if "@" in text:
        out += [(b, 0, e) for b, e in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


class Layer:
    """One rewriting of a text: replaced output spans with the source spans they stand for, in order."""

    def __init__(self, text: str, changes: list[tuple[int, int, str]]):
        out, at, length = [], 0, 0
        self.edits: list[tuple[int, int, int, int]] = []
        for begin, end, new in changes:
            out += [text[at:begin], new]
            length += begin - at
            self.edits.append((length, length + len(new), begin, end))
            length += len(new)
            at = end
        out.append(text[at:])
        self.text = "".join(out)
        self.starts = [e[0] for e in self.edits]

    def back(self, pos: int, last: bool) -> int:
        """Source position of an output character; the last source character of a replacement if ``last``."""
        i = bisect_right(self.starts, pos) - 1
        if i < 0:
            return pos
        _, out_end, begin, end = self.edits[i]
        if pos < out_end:
            return end - 1 if last else begin
        return end + pos - out_end

    def source_span(self, begin: int, end: int) -> tuple[int, int, bool]:
        """Source span of an output span, and whether it holds a rewritten place."""
        i = bisect_left(self.starts, end) - 1  # the last edit that starts before the end
        touched = i >= 0 and (self.edits[i][1] > begin or self.edits[i][0] > begin)
        return self.back(begin, False), self.back(end - 1, True) + 1, touched


def look_changes(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), LOOKALIKES.get(m.group(), "")) for m in LOOKS.finditer(text)]


def digit_changes(text: str) -> list[tuple[int, int, str]]:
    out = []
    for run in SPELLED_RUN.finditer(text):
        for m in SPELLED_ONE.finditer(run.group()):
            word = (m["digit"] or "").lower()
            new = "+" if m["plus"] else SPELLED.get(word, word) * TIMES.get((m["times"] or "").lower(), 1)
            if new != m.group():
                out.append((run.start() + m.start(), run.start() + m.end(), new))
    return out


def local_changes(text: str, at: int, free: int) -> list[tuple[int, int, str]]:
    """Spoken dots in the local part that ends at ``at``."""
    begin = max(free, at - LOCAL_REACH)
    m = LOCAL_DOTS.search(text[begin:at])
    return [(begin + d.start(), begin + d.end(), ".") for d in SPOKEN_DOT.finditer(text[begin:at], m.start())] if m else []


def mark_changes(text: str) -> list[tuple[int, int, str]]:
    out, free = [], 0
    for m in BRACKETED.finditer(text):
        dot = m.group(1).lower() in DOT_WORDS | DOT_BESIDE
        if not dot:
            out += local_changes(text, m.start(), free)
        out.append((m.start(), m.end(), "." if dot else "@"))
        free = m.end()
    return out


def spoken_changes(text: str) -> list[tuple[int, int, str]]:
    """Anchored at the word for '@': a spoken domain must follow and a local part precede."""
    out, free = [], 0
    for m in SPOKEN_AT.finditer(text):
        if m.start() < free:
            continue
        domain = (DOMAIN_AFTER_AT if m.group(1).lower() == "at" else DOMAIN_AFTER_SURE).match(text, m.end())
        if not domain:
            continue
        begin = local_begin(text, m.start(), free)
        if begin == m.start() or (begin > free and (text[begin - 1].isalnum() or text[begin - 1] in "_.")):
            continue
        out += local_changes(text, m.start(), free)
        out.append((m.start(), m.end(), "@"))
        out += [(d.start(), d.end(), ".") for d in SPOKEN_DOT.finditer(text, m.end(), domain.end())]
        free = domain.end()
    return out


SPOKEN_DOTS = [f" {w} " for w in sorted(DOT_WORDS | DOT_BESIDE)]


def tail_changes(text: str) -> list[tuple[int, int, str]]:
    """Spoken dots in the domain after a real '@'."""
    return [(d.start(), d.end(), ".") for m in SPOKEN_TAIL.finditer(text)
            for d in SPOKEN_DOT.finditer(text, m.start(), m.end())]


def disguised(text: str) -> list[tuple[int, int, int]]:
    """Spans of identifiers that only show after deobfuscation."""
    layers, now, low = [], text, None
    for name, change in (("looks", look_changes), ("digits", digit_changes), ("marks", mark_changes),
                         ("spoken", spoken_changes), ("tail", tail_changes)):
        if name == "looks":
            possible = not now.isascii()
        else:  # plain substring tests that must hold for the layer to change anything
            low = now.lower() if low is None else low
            possible = (any(w in low for w in SPELLED) if name == "digits" else
                        any(c in now for c in "[({<") if name == "marks" else any(w in low for w in SPOKEN_DOTS))
        if not possible:
            continue
        changes = change(now)
        if changes:
            layers.append(Layer(now, changes))
            now, low = layers[-1].text, None
    if not layers:
        return []
    out = []
    for begin, kind, end in detect(now):
        touched = False
        for layer in reversed(layers):
            begin, end, hit = layer.source_span(begin, end)
            touched |= hit
        if touched:
            out.append((begin, kind, end))
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of one text, as sorted (start, kind, end)."""
    text = text or ""
    base = detect(text)
    added = []
    for begin, kind, end in disguised(text):
        # a base span stays; a longer identifier that it is a part of is added beside it
        if not any(k == kind and b < end and e > begin and (b < begin or e > end or (b, e) == (begin, end)) for b, k, e in base):
            added.append((begin, kind, end))
    return base, sorted(base + added)


SPAN = T.StructType([T.StructField("begin", T.LongType()), T.StructField("kind", T.StringType()),
                     T.StructField("end", T.LongType())])


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``pii_base`` and ``pii_spans``: arrays of (begin, kind, end).

    Positions count code points of the source text, ends are exclusive.  Null and empty texts have no
    spans; each row is scanned on its own, so ties and repeated rows do not matter; an empty table
    gives an empty result; other columns pass through (``pii_base`` and ``pii_spans`` are replaced).
    """
    keep = [c for c in docs.columns if c not in (text, "pii_base", "pii_spans")]
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField("pii_base", T.ArrayType(SPAN)), T.StructField("pii_spans", T.ArrayType(SPAN))])
    kind_type = pa.list_(pa.struct([("begin", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [scan(t.as_py()) for t in batch.column(text)]
            cols = [batch.column(c) for c in keep]
            for i in (0, 1):
                cols.append(pa.array([[{"begin": b, "kind": KINDS[k], "end": e} for b, k, e in x[i]] for x in both],
                                     kind_type))
            yield pa.RecordBatch.from_arrays(cols, [*keep, "pii_base", "pii_spans"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def op2_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    out = find_pii(documents(spark, sf_dir).select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")

    kinds = F.transform("pii_base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in KINDS]
    counts = [(F.size("pii_base") - c).cast("bigint").alias(f"n_{k}") for k, c in zip(KINDS, counts)]
    return out.select("doc_id", *counts, F.sha2(joined("pii_base").cast("binary"), 256).alias("base_sha256"),
                      joined("pii_spans").alias("spans"))


QUERIES = {"op2_deobfuscated_pii": op2_deobfuscated_pii}
ORACLE: dict[str, str] = {}
