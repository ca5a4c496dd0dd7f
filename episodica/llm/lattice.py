"""Text likelihood by a subword lattice.

The pieces of an existing vocabulary are arcs over a word's characters. An arc's weight
starts from the vocabulary's own scores (a score is minus a rank; ranks weigh 1 / (rank + 2))
and is sharpened by the pieces' expected numbers in the distinct training words, whatever their
length (``PASSES`` passes of forward and backward sums). The forward recursion, in logs, sums
all segmentations (``segmentations``, for many words at once). A word seen in training is one more arc with its discounted count,
and the lattice gets the mass that the discount frees:

    P(w) = (max(c - d, 0) + d * V * lattice(w)) / N,   d = n1 / (n1 + 2 * n2)

c, N and V count tokens (words, and one end per text) in all training rows; n1 and n2 are
the numbers of tokens seen once and twice. Counting and scoring are Spark jobs: words are
counted per task before they are shuffled; the ``HEAD`` most frequent words (a bounded table)
are scored where the text is, all others by a join, so no join key is hot.

Defined results: null and empty texts have the end token alone; without training rows the
lattice alone scores; rows may repeat, each is scored by itself; characters outside the
vocabulary go by their bytes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.segmentations import Pieces, Segmentations
from episodica.llm.tables import kept_in_worker, slices, written

HEAD = 100_000
PASSES = 2
PRIOR = 1000.0
SMOOTH = 0.1
MARK = "▁"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().translate(LOWER).split()


class Lattice:
    """Probability of words, summed over all segmentations into pieces.

    ``counts`` are the pieces' expected numbers from an earlier pass; without any, the
    vocabulary's own scores weigh alone.
    """

    def __init__(self, model: bytes, counts: dict[str, float]):
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = pieces.get_piece_size()
        prior = {}
        for i in range(size):
            if not (pieces.is_control(i) or pieces.is_unknown(i)):
                # Byte pieces carry no rank; they count as the last ones.
                rank = size if pieces.is_byte(i) else -pieces.get_score(i)
                prior[pieces.id_to_piece(i)] = 1.0 / (max(rank, 0.0) + 2.0)
        mass, total = sum(prior.values()), sum(counts.values())
        weight = {p: (counts.get(p, 0.0) + PRIOR * w / mass) / (total + PRIOR) for p, w in prior.items()}
        byte = [weight.pop(f"<0x{b:02X}>", 1e-9) for b in range(256)]
        self.stop = sum(w for p, w in weight.items() if p.startswith(MARK))
        self.weight, self.names = weight, list(weight)
        found = kept_in_worker(f"pieces:{hash(tuple(self.names))}", lambda: Pieces(self.names))
        self.sums = Segmentations(found, np.log(list(weight.values())), np.log(byte))

    def log10(self, words: list[str]) -> np.ndarray:
        """Log probability of each word: all segmentations, and that the word ends."""
        return (self.sums.log_sums([MARK + w for w in words]) + math.log(self.stop)) / math.log(10)

    def expected(self, words: list[str]) -> np.ndarray:
        """The expected number of each piece of ``names`` in all words together."""
        return self.sums.expected([MARK + w for w in words])


def word_counts(rows: DataFrame) -> DataFrame:
    """word, training count and count in all rows; ``rows`` has text and held_out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, rest = Counter(), Counter()

        def out():
            words = list(train.keys() | rest.keys())
            columns = [pa.array([w.decode() for w in words], pa.string()), pa.array([train[w] for w in words], pa.int64()), pa.array([train[w] + rest[w] for w in words], pa.int64())]
            train.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "c", "everywhere"])

        for batch, texts in slices(batches, 0):
            for text, held in zip(texts, batch.column(1).to_pylist(), strict=True):
                (rest if held else train).update(words_of(text))
            if len(train) + len(rest) > 400_000:
                yield out()
        yield out()

    counted = rows.select("text", "held_out").mapInArrow(run, "word string, c long, everywhere long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("everywhere").alias("everywhere"))


def piece_counts(words: DataFrame, model: bytes, counts: dict[str, float]) -> dict[str, float]:
    """Expected numbers of the vocabulary's pieces in the distinct training words.

    Every distinct word counts once, since the lattice is to tell unseen words. The result
    has at most one number per piece of the vocabulary.
    """
    shared = words.sparkSession.sparkContext.broadcast((model, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        found = np.zeros(len(lattice.names))
        for batch in batches:
            found += lattice.expected(batch.column(0).to_pylist())
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([lattice.names[i] for i in some], pa.string()), pa.array(found[some])], names=["piece", "n"])

    found = words.filter("c > 0").select("word").mapInArrow(run, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in found.collect()}


def most_frequent(words: DataFrame, head: int) -> DataFrame:
    """At most ``head`` words, all above a count found from a histogram of a few thousand steps."""
    stepped = words.withColumn("_step", F.floor(F.log2("everywhere") * 64))
    total, least = 0, None
    for row in stepped.groupBy("_step").count().orderBy(F.col("_step").desc()).collect():
        total += row["count"]
        if total > head:
            break
        least = row["_step"]
    return stepped.filter(F.col("_step") >= F.lit(least) if least is not None else F.lit(False)).drop("_step")


def likelihood(docs: DataFrame, vocabulary_path: str, held_out, id_column: str = "doc_id", text_column: str = "text", head: int = HEAD, passes: int = PASSES) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_column).alias("id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).alias("text"))
    words = written(word_counts(rows), "words")
    ends = rows.filter("NOT held_out").count()
    known = words.filter("c > 0").agg(F.count("*").alias("types"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")).first()
    total, types = known["n"] + ends, known["types"] + (ends > 0)
    discount = known["once"] / max(1, known["once"] + 2 * known["twice"])
    floor = math.log10(total + SMOOTH * (types + 1))

    def blended(count: int, lattice: float) -> float:
        if not total:
            return lattice
        if discount == 0 and count == 0:
            return lattice - math.log10(total + 1)
        return math.log10((max(count - discount, 0.0) + discount * types * 10.0**lattice) / total) if lattice > -300 or count else math.log10(discount * types / total) + lattice

    counts: dict[str, float] = {}
    for _ in range(passes):
        counts = piece_counts(words, vocabulary, counts)
    pieces = context.broadcast((vocabulary, counts))

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*pieces.value)
        for batch in batches:
            counts = batch.column("c").to_pylist()
            score = [blended(n, s) for s, n in zip(lattice.log10(batch.column("word").to_pylist()).tolist(), counts, strict=True)]
            base = [math.log10(n + SMOOTH) - floor for n in counts]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), batch.column("everywhere"), pa.array(score), pa.array(base)], names=["word", "c", "everywhere", "s", "b"])

    valued = written(words.mapInArrow(score_words, "word string, c long, everywhere long, s double, b double"), "valued")
    frequent = most_frequent(valued, head).collect()
    shared = context.broadcast({r["word"].encode(): (r["s"], r["b"], r["c"] > 0) for r in frequent})
    end = (blended(ends, -300.0), math.log10(ends + SMOOTH) - floor, int(ends > 0))

    def score_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))
        for batch, texts in slices(batches, 2):
            out, rest = [], []
            for text in texts:
                counts = Counter(words_of(text))
                s, b, seen, others = [end[0]], [end[1]], end[2], []
                for word, n in counts.items():
                    found = top.get(word)
                    if found is None:
                        others.append({"word": word.decode(), "n": n})
                    else:
                        s.append(n * found[0])
                        b.append(n * found[1])
                        seen += n * found[2]
                out.append((sum(counts.values()) + 1, seen, math.fsum(b), math.fsum(s)))
                rest.append(others)
            numbers = [pa.array(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, pa.array(rest, kind)], names=["id", "held_out", "n_tokens", "n_known", "b", "s", "rest"])

    kind = docs.schema[id_column].dataType.simpleString()
    scored = rows.mapInArrow(score_texts, f"id {kind}, held_out boolean, n_tokens long, n_known long, b double, s double, rest array<struct<word:string,n:int>>")
    # Written once, so that the row keys hold for everything below.
    scored = written(scored.withColumn("key", F.monotonically_increasing_id()), "texts")
    others = scored.select("key", F.explode("rest").alias("r")).select("key", "r.word", "r.n")
    sums = (
        others.join(valued.select("word", "c", F.col("s").alias("ws"), F.col("b").alias("wb")), "word")
        .groupBy("key")
        .agg(F.sum(F.col("n") * F.col("ws")).alias("s2"), F.sum(F.col("n") * F.col("wb")).alias("b2"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k2"))
    )
    zero = F.lit(0)
    return scored.drop("rest").join(sums, "key", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("k2", zero)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("b") + F.coalesce("b2", F.lit(0.0))).alias("base_score"),
        (F.col("s") + F.coalesce("s2", F.lit(0.0))).alias("score"),
    )
