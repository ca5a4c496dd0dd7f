"""Toxic passages as maximum-scoring segments.

Tokens are lower-cased words and the word beginnings of four, five and six letters, which
carry over to forms never seen. A token's score is its log-odds between toxic and clean
documents under a Dirichlet prior spread by the tokens' overall shares (documents are
counted, so one document's repetitions weigh once). Each word takes its most significant
token; words without one cost a small constant, so that clean text drifts down. One linear
scan gives all maximal scoring segments. Their scores are measured by the extreme-value law
of segment scores in clean text (lambda from the scores' distribution, length n):
normal(S) = lambda * S - ln(n). A logistic curve over the best segment, the sum of the
significant ones and the length, fitted to the same training rows, gives the score.

The model learns from at most ``TRAIN_ROWS`` labelled rows, the ones with the smallest
hash of their identifier; everything else reads all rows and whole texts.

Defined results: null and empty texts get the score of a text without any word; labels that
are null are left out, of repeated labels the highest counts; without toxic and clean
training rows every score is 0; rows may repeat, each is scored by itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.tables import keyed, only, slices, smallest_hashes, written

TRAIN_ROWS = 40_000
PRIOR = 20.0
"""Weight of the prior, in documents per token of average share."""
LEAST_Z, LEAST_ODDS, LEAST_DOCS = 3.5, 2.0, 5
"""A token counts if its log-odds are large and sure enough, and if enough documents hold it."""
BEGINNINGS = (4, 5, 6)
SIGNIFICANT = 0.5
"""Normalised score from which a segment counts as significant."""

words_of = re.compile(r"\w+").findall


def tokens_of(word: str) -> list[str]:
    return [word] + ["^" + word[:k] for k in BEGINNINGS if len(word) >= k]


class Scores:
    """Score of a word: that of its most significant token, or None."""

    def __init__(self, tokens: dict[str, tuple[float, float]], drift: float, scale: float):
        self.tokens, self.drift, self.scale = tokens, drift, scale
        self.known: dict[str, float | None] = {}

    def of(self, word: str) -> float | None:
        if word not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            found = [self.tokens[t] for t in tokens_of(word) if t in self.tokens]
            self.known[word] = max(found, key=lambda x: abs(x[1]))[0] if found else None
        return self.known[word]

    def segments(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """All maximal scoring segments as (first word, last word + 1, score), and the number of words."""
        words = words_of(text.lower())
        hits = [(i, s) for i, w in enumerate(words) if (s := self.of(w)) is not None]
        # Each entry: first, end, sum left of it, sum through its right end.
        stack: list[tuple[int, int, float, float]] = []
        total, at = 0.0, 0
        for i, score in hits:
            total += self.drift * (i - at)
            at = i + 1
            left, total = total, total + score
            if score <= 0:
                continue
            entry = (i, i + 1, left, total)
            while True:
                # The last segment with a smaller left sum swallows everything after it, if its right sum is smaller too.
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= entry[2]:
                    j -= 1
                if j < 0 or stack[j][3] >= entry[3]:
                    stack.append(entry)
                    break
                entry = (stack[j][0], entry[1], stack[j][2], entry[3])
                del stack[j:]
        return [(a, b, right - left) for a, b, left, right in stack], len(words)

    def features(self, text: str) -> tuple[float, float, float]:
        segments, n = self.segments(text)
        normal = [self.scale * s - np.log(n) for _, _, s in segments]
        return (max([0.0, *normal]), sum(x for x in normal if x >= SIGNIFICANT), float(np.log1p(n)))


def training_rows(docs: DataFrame, labels: DataFrame, held_out, id_column: str, text_column: str, label_column: str, limit: int) -> DataFrame:
    """text and label of at most ``limit`` labelled rows outside the held-out fold."""
    marked = labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).filter(~held_out(F.col(id_column)))
    marked = marked.groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).cast("int").alias("_label"))
    chosen = smallest_hashes(marked, limit, "_id")
    # At most ``limit`` pairs of numbers are sent to every task.
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(chosen), "_id").select("_text", "_label")


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def rows():
        tokens = list(counts[0].keys() | counts[1].keys())
        out = [pa.array(tokens, pa.string())] + [pa.array([c[t] for t in tokens], pa.int64()) for c in counts]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(out, names=["token", "clean", "toxic"])

    for batch, texts in slices(batches, 0):
        for text, label in zip(texts, batch.column(1).to_pylist(), strict=True):
            counts[min(1, max(0, label))].update({t for w in set(words_of(text.lower())) for t in tokens_of(w)} | {""})
        if len(counts[0]) + len(counts[1]) > 400_000:
            yield rows()
    yield rows()


def fit(docs: DataFrame, labels: DataFrame, held_out, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", limit: int = TRAIN_ROWS) -> dict | None:
    """Token scores, the law of segment scores and the calibration curve."""
    train = written(training_rows(docs, labels, held_out, id_column, text_column, label_column, limit), "toxic-train")
    counts = train.mapInArrow(_count_tokens, "token string, clean long, toxic long").groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = written(counts, "toxic-tokens")
    size = counts.filter("token = ''").first()
    if size is None or not size["clean"] or not size["toxic"]:
        return None
    n0, n1 = float(size["clean"]), float(size["toxic"])
    mass = counts.filter("token != ''").agg(F.sum(F.col("clean") + F.col("toxic")).alias("m"), F.count("*").alias("v")).first()
    share = (F.col("clean") + F.col("toxic")) / F.lit(float(mass["m"]))
    prior = share * F.lit(PRIOR * float(mass["v"]) ** 0.5)
    prior = F.least(F.greatest(prior, F.lit(0.5)), F.lit(PRIOR))

    def odds(found, n):
        return F.log((found + prior) / F.greatest(F.lit(n) + prior - found, F.lit(0.5)))

    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    z = delta / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    kept = counts.filter((F.col("token") != "") & (F.col("toxic") + F.col("clean") >= LEAST_DOCS)).select("token", "clean", delta.alias("delta"), z.alias("z")).filter((F.abs("z") >= LEAST_Z) & (F.abs("delta") >= LEAST_ODDS))
    # Significant tokens of at most ``limit`` training rows: the rows bound them.
    tokens = {r["token"]: (float(r["delta"]), float(r["z"])) for r in kept.collect()}
    model = {"tokens": tokens, "drift": -0.01, "scale": 1.0}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, histogram = Scores(**shared.value), Counter()
        for batch, texts in slices(batches, 0):
            for text, label in zip(texts, batch.column(1).to_pylist(), strict=True):
                if label <= 0:
                    for word in words_of(text.lower()):
                        histogram[round(s, 1) if (s := scores.of(word)) is not None else None] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(histogram), pa.float64()), pa.array(list(histogram.values()), pa.int64())], names=["score", "n"])

    law = train.mapInArrow(clean_scores, "score double, n long").groupBy("score").sum("n").collect()
    model |= segment_law({r[0]: r[1] for r in law})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(**shared.value)
        for batch, texts in slices(batches, 0):
            columns = np.array([scores.features(t) for t in texts], float).T
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), batch.column(1)], names=["a", "b", "c", "label"])

    measured = train.mapInArrow(measure, "a double, b double, c double, label int").toPandas().to_numpy(float)
    return model | {"curve": logistic(measured[:, :3], np.minimum(measured[:, 3], 1.0))}


def segment_law(histogram: dict[float | None, int]) -> dict:
    """drift and scale (lambda): the mean score is negative and sum p * exp(lambda * score) is 1."""
    total = max(1, sum(histogram.values()))
    share = {s: n / total for s, n in histogram.items() if s is not None}
    drift = min(-0.01, -2 * sum(p * s for s, p in share.items() if s > 0) - 0.01)
    scores = np.array([drift, *share])
    shares = np.array([1 - sum(share.values()), *share.values()])
    low, high = 1e-6, 5.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if (shares * np.exp(np.minimum(middle * scores, 60))).sum() > 1 else (middle, high)
    return {"drift": drift, "scale": low}


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1e-3) -> list[float]:
    """Intercept and slopes by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
    return w.tolist()


def scored(docs: DataFrame, model: dict | None, id_column: str = "doc_id", text_column: str = "text", passages: bool = True) -> DataFrame:
    """id, score and the significant passages (first and end word, score, expected number by chance)."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, score double, passages array<struct<first:int,end:int,score:double,expected:double>>"
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    if model is None:
        return rows.select("id", F.lit(0.0).alias("score"), F.expr("array()").cast("array<struct<first:int,end:int,score:double,expected:double>>").alias("passages"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = dict(shared.value)
        curve = np.array(found.pop("curve"))
        scores = Scores(**found)
        for batch, texts in slices(batches, 1):
            x = np.array([scores.features(t) for t in texts], float)
            score = 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30)))
            spans = [[] for _ in texts]
            for at in np.flatnonzero(x[:, 1] > 0) if passages else ():
                segments, n = scores.segments(texts[at])
                normal = [(a, b, s, scores.scale * s - np.log(n)) for a, b, s in segments]
                spans[at] = [{"first": a, "end": b, "score": s, "expected": float(np.exp(-v))} for a, b, s, v in normal if v >= SIGNIFICANT]
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(spans, kind)], names=["id", "score", "passages"])

    return rows.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that score below ``threshold``, with all their columns."""
    model = fit(docs, labels, held_out, id_column, text_column)
    rows = keyed(docs, id_column)
    found = scored(rows.select("key", F.col(f"row.`{text_column}`").alias("text")), model, "key", "text", passages=False)
    return only(rows, found.filter(F.col("score") < threshold))
