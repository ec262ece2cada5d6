"""Toxic passages by maximum-scoring segments over token log-odds.

Learning: tokens of labelled documents are counted by label (once per
document), as whole words and as prefixes of 3 to 7 letters, which hold for inflected and compound
forms.  They get log-odds with an informative Dirichlet prior (PRIOR of all counts, spread
as the overall frequencies).  A token scores the largest log-odds among its forms with a significant positive
z-score; every other token scores the (negative) drift, so the expected score of ordinary text is negative.

Scoring: one linear pass (Ruzzo and Tompa) finds all maximal scoring segments of
a text.  Maximal scores of n ordinary tokens follow an extreme-value law: score - ln(n) is Gumbel
with location and scale fitted on the non-toxic training documents.  A document's evidence
is the sum of its segments' scores above that location in units of the scale; a
one-variable logistic curve fitted on the training documents turns it into [0, 1].

Only labels are learned from a bounded sample: at most MAX_TRAIN labelled documents, chosen by
the md5 of doc_id.  Held-out documents (crc32 of doc_id mod 3 = 1) never enter.  The model is at most
MAX_TOKENS weights and five numbers; every document is scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowcube.llm.common import documents
from flowcube.operators.materialize import materialize
from flowcube.sources.tables import table

#: Labelled documents to learn from, at most.
MAX_TRAIN = 20_000
#: Token weights in the model, at most (those of highest z-score).
MAX_TOKENS = 20_000
#: Dirichlet prior mass, as a share of all counts.
PRIOR = 0.05
#: Least z-score of a scoring form.
MIN_Z = 4.0
#: Lengths of prefixes.
PREFIXES = range(3, 8)
#: predicted = 1 from this score on.
CUT = 0.7

EDGES = ".,;:!?\"'()[]{}<>*_~`-/\\|%&$#@+=^"


@dataclass
class Model:
    weights: dict[str, float]
    drift: float
    mu: float
    beta: float
    slope: float
    bias: float


def tokens(text: str | None) -> list[str]:
    """Lower-case words without outer punctuation."""
    return [w.strip(EDGES) for w in (text or "").lower().split()]


class Scores:
    """Score of a token: the largest weight among its forms, None without any; remembered per token."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.known = weights, {}

    def get(self, token: str) -> float | None:
        if token not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            forms = [token, *(token[:k] + "*" for k in PREFIXES if len(token) >= k)]
            self.known[token] = max((self.weights[f] for f in forms if f in self.weights), default=None)
        return self.known[token]


def segments(words: list[str], weights: dict[str, float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) of a token sequence, left to right, in linear time.

    Only tokens with a weight are visited; a gap of g other tokens scores g * drift.
    """
    stack: list[tuple[int, int, float, float]] = []  # begin, end, total before, total after
    links: list[int] = []  # per stack entry: nearest earlier entry with a smaller total before
    total, last = 0.0, 0
    get = weights.get
    for i, w in enumerate(words):
        s = get(w)
        if s is None:
            continue
        total += (i - last) * drift
        begin, end, left, right = i, i + 1, total, total + s
        total, last = right, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = links[j]
            if j < 0 or stack[j][3] >= right:
                stack.append((begin, end, left, right))
                links.append(j)
                break
            begin, left = stack[j][0], stack[j][2]
            del stack[j:], links[j:]
    return [(b, e, r - lo) for b, e, lo, r in stack]


def evidence(found: list[tuple[int, int, float]], n: int, mu: float, beta: float) -> float:
    shift = log(n + 1) + mu
    return sum(max(0.0, s - shift) for _, _, s in found) / beta


def score_text(text: str | None, model: Model, scores: Scores | None = None) -> tuple[float, list[tuple[int, int, float]]]:
    words = tokens(text)
    found = segments(words, scores or Scores(model.weights), model.drift)
    x = model.bias + model.slope * evidence(found, len(words), model.mu, model.beta)
    return (1 / (1 + exp(-x)) if x > -700 else 0.0), found


def fold(doc_id: str = "doc_id"):
    """crc32 of doc_id as text (null: empty), modulo 3."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(text, toxic) of at most about ``max_train`` labelled documents outside the held-out fold."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(fold() != 1).withColumn("u", F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10)
                                                .cast("double") / 4294967296.0)
    total = known.count()
    known = known.filter(F.col("u") < max_train / max(total, 1)).select("doc_id", "toxic")
    # about max_train rows of 12 bytes, whatever the size of the labels table
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_tokens: int = MAX_TOKENS) -> Model:
    """Fit the model; without both labels present every score is the prior share of toxic labels."""
    rows = materialize(training_rows(docs, labels, max_train))
    words = F.array_distinct(F.transform(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), lambda w: F.btrim(w, F.lit(EDGES))))
    seen = rows.select("toxic", F.explode(words).alias("token")).filter("token <> ''")
    counts = materialize(seen.groupBy("token").agg(F.sum("toxic").alias("yt"), F.sum(1 - F.col("toxic")).alias("yn")))
    totals = counts.agg(F.sum("yt").alias("nt"), F.sum("yn").alias("nn")).first()
    nt, nn = float(totals["nt"] or 0), float(totals["nn"] or 0)
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    if not nt or not nn:
        return Model({}, -0.1, 0.0, 1.0, 0.0, log((share + 1e-3) / (1 - share + 1e-3)))
    forms = F.array(F.col("token"), *[F.when(F.length("token") >= k, F.concat(F.substring("token", 1, k), F.lit("*"))) for k in PREFIXES])
    by_form = counts.select("yt", "yn", F.explode(forms).alias("form")).filter("form is not null").groupBy("form").agg(
        F.sum("yt").alias("yt"), F.sum("yn").alias("yn"))
    prior, mass = F.lit(PRIOR) * (F.col("yt") + F.col("yn")), PRIOR * (nt + nn)
    a, b = F.col("yt") + prior, F.col("yn") + prior
    odds = F.log(a / (nt + mass - a)) - F.log(b / (nn + mass - b))
    model = by_form.filter("yt > 1").withColumn("w", odds).withColumn("z", odds / F.sqrt(1 / a + 1 / b))
    picked = model.filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "form").limit(max_tokens).collect()
    weights = {r["form"]: min(float(r["w"]), 8.0) for r in picked}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(weights)
        for batch in batches:
            found = [tokens(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                pa.array([len(w) for w in found], pa.int64()),
                pa.array([sum(scores.get(x) is not None for x in w) for w in found], pa.int64())], ["n", "k"])

    dense = rows.filter("toxic = 1").select("text").mapInArrow(hits, "n bigint, k bigint").agg(F.sum("n"), F.sum("k")).first()
    drift = log(1 - min(max((dense[1] or 0) / max(dense[0] or 0, 1), 0.005), 0.2))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(weights)
        for batch in batches:
            n, top_score, all_scores = [], [], []
            for text in batch.column("text"):
                found_words = tokens(text.as_py())
                found = [s for _, _, s in segments(found_words, scores, drift)]
                n.append(len(found_words))
                top_score.append(max(found, default=0.0))
                all_scores.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(n, pa.int64()), pa.array(top_score, pa.float64()),
                                              pa.array(all_scores, pa.list_(pa.float64()))], ["toxic", "n", "top", "all"])

    fitted = rows.mapInArrow(best, "toxic int, n bigint, top double, all array<double>").collect()  # max_train rows
    gaps = np.array([r["top"] - log(r["n"] + 1) for r in fitted if not r["toxic"] and r["top"] > 0] or [0.0])
    beta = max(float(gaps.std()) * 6 ** 0.5 / np.pi, 0.5)
    mu = min(float(gaps.mean()) - 0.5772156649 * beta, 0.0)
    x = np.array([evidence([(0, 0, s) for s in r["all"]], r["n"], mu, beta) for r in fitted])
    y = np.array([float(r["toxic"]) for r in fitted])
    # rows come in any order; sorting makes the sums, and so the model, the same in every run
    order = np.lexsort((y, x))
    x, y = np.minimum(x[order], 50.0), y[order]
    slope, bias = 0.0, log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(50):  # Newton steps on the penalised log-likelihood
        p = 1 / (1 + np.exp(-(bias + slope * x)))
        v = p * (1 - p)
        g = np.array([(y - p).sum(), ((y - p) * x).sum() - 0.01 * slope])
        h = np.array([[v.sum() + 1e-9, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 0.01]])
        step = np.linalg.solve(h, g)
        bias, slope = bias + float(np.clip(step[0], -2, 2)), slope + float(np.clip(step[1], -2, 2))
        if abs(step).max() < 1e-9:
            break
    return Model(weights, drift, mu, beta, max(slope, 0.0), bias)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus ``tox_score`` and ``tox_passages`` (begin word, end word, score) for every row.

    Null and empty texts have no passages and get the score of no evidence; rows are scored one by one,
    so ties and repeated rows do not matter; an empty table gives an empty result.
    """
    from pyspark.sql import types as T
    passage = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("tox_score", T.DoubleType()),
                                                            T.StructField("tox_passages", T.ArrayType(passage))])
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model.weights)
        for batch in batches:
            scored = [score_text(t.as_py(), model, scores) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array([s for s, _ in scored], pa.float64()), pa.array(
                    [[{"begin": b, "end": e, "score": v} for b, e, v in f if v > log(1 + e - b) + model.mu] for _, f in scored], kind)],
                schema.names)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and decision of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", (fold() == 1).alias("held_out"), F.col("tox_score").alias("score"),
                      (F.col("tox_score") >= CUT).cast("int").alias("predicted"), F.size("tox_passages").alias("n_passages"))


QUERIES = {"op8_toxic_segments": op8_toxic_segments}
ORACLE: dict[str, str] = {}
