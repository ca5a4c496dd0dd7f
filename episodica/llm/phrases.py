"""Phrase collocations from the counts of multikey quicksort.

A pointer for each word stands for the suffix that begins there: the word and those behind it in
its piece, at most ``longest``. Multikey three-way quicksort splits pointers by one word at a
time; the pointers of an equal partition share a phrase, so their number is its count. It goes
to depth ``longest`` and no further.

* Inside a task the suffixes of ``TEXT`` characters are sorted, and equal ones travel as one
  with their number, many in an array.
* They are routed by their leading words: by one word, or by one more for each leading word that
  makes up over 1 / ``HOT`` of all words (there are at most ``HOT`` of these, so their list is
  small whatever the input). No route holds a larger share of the suffixes than that. Routes
  are dealt to buckets of about ``POINTERS`` suffixes each, so there are more with more data.
* Where all suffixes of a route are together, quicksort abandons a partition, less and greater
  ones too, as soon as it has under ``least`` occurrences: no phrase of it can be frequent.
  Shorter phrases than the route's words are summed over routes.

Counts are 64-bit and scores are decimals of 38 digits: exact up to 10**16 occurrences.
Defined results: null and empty texts have no words; a null ``lang`` is ``und``; repeated rows
count each; ties are settled by count and phrase; an empty table gives an empty table. Texts
and words of any length are taken whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodica.llm.tables import slices, text_or_empty, written

BREAKS = ".,;:!?\n\v\f\r"
"""Characters that end a piece; blanks and tabs part words."""
TEXT = 4_000_000
"""Characters of text whose suffixes are sorted at once; a longer text is taken whole."""
POINTERS = 500_000
"""Suffixes of a bucket."""
TOGETHER = 256
"""Suffixes in one array, so that a batch of rows stays small."""
SHORT = 2048
"""A partition of so few pointers is finished by a plain sort."""
HOT = 10_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in BREAKS]] = 2


def words_of(texts: list[str]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """All words, the text of each, and the number of its piece (never shared by two texts)."""
    raw = [t.encode() for t in texts]
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    data = LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    kind = KIND[data]
    inside = kind == 0
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32 if len(data) < 1 << 31 else np.int64)[begin]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside]))
    return words, np.searchsorted(begins, begin, "right") - 1, piece


def suffixes(word: np.ndarray, piece: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each pointer the words at 0 .. ``longest`` - 1 behind it; -1 beyond the piece's end."""
    columns = [word]
    for k in range(1, longest):
        column = np.full(len(word), -1, word.dtype)
        column[:-k] = np.where(piece[k:] == piece[:-k], word[k:], -1)[: max(0, len(word) - k)]
        columns.append(column)
    return columns


def equal_partitions(columns: list[np.ndarray], weight: np.ndarray, least: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, a pointer, weight) of partitions that agree on ``depth`` columns and weigh ``least`` or more.

    Multikey three-way quicksort: a partition is split into less, equal and greater at the
    middle of nine values; the equal part goes on with the next column, the two others with the
    same one. A negative value ends a suffix.
    """
    depths = len(columns)
    stack = [(np.arange(len(weight)), 0)]
    while stack:
        pointers, depth = stack.pop()
        if not len(pointers) or (least and weight[pointers].sum() < least):
            continue
        if len(pointers) <= SHORT:
            yield from _finished(columns, weight, pointers, depth, least)
            continue
        values = columns[depth][pointers]
        pivot = np.sort(values[:: max(1, len(values) // 9)][:9])[4]
        equal = pointers[values == pivot]
        stack.append((pointers[values < pivot], depth))
        stack.append((pointers[values > pivot], depth))
        total = weight[equal].sum()
        if pivot < 0 or total < least:
            continue
        yield depth + 1, equal[:1], np.array([total])
        if depth + 1 < depths:
            stack.append((equal, depth + 1))


def _finished(columns, weight, pointers, depth, least):
    order = pointers[np.lexsort([c[pointers] for c in columns[depth:][::-1]])] if len(pointers) > 1 else pointers
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    alive = np.ones(len(order), bool)
    for at in range(depth, len(columns)):
        values = columns[at][order]
        fresh[1:] |= values[1:] != values[:-1]
        alive &= values >= 0
        starts = np.flatnonzero(fresh)
        sums = np.add.reduceat(weight[order], starts)
        good = alive[starts] & (sums >= least)
        if good.any():
            yield at + 1, order[starts[good]], sums[good]


def combined(columns: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A pointer and the weight of each distinct suffix, shorter ones at a piece's end included."""
    shifted = [c + 1 for c in columns]
    found = [(p, w) for depth, p, w in equal_partitions(shifted, weight) if depth == len(columns)]
    return (np.concatenate([p for p, _ in found]), np.concatenate([w for _, w in found])) if found else (np.zeros(0, np.int64),) * 2


def _joined(words: pa.Array, columns: list[np.ndarray], pointers: np.ndarray) -> pa.Array:
    """The words behind each pointer, joined by blanks."""
    parts = [words.take(pa.array(c[pointers], mask=c[pointers] < 0)) for c in columns]
    return pc.binary_join_element_wise(*parts, pa.scalar(" ", words.type), null_handling="skip").cast(pa.string())


def _chunks(batches: Iterator[pa.RecordBatch], limit: int):
    """words, lang of each word, langs and pieces of about ``limit`` characters of text."""
    for batch, texts in slices(batches, 1, limit):
        words, text, piece = words_of(texts)
        langs = batch.column(0).dictionary_encode()
        yield words.dictionary_encode(), langs.indices.to_numpy(zero_copy_only=False)[text], langs.dictionary, piece


def _prepared(docs: DataFrame, lang_column: str, text_column: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_column).alias("text"))


def word_counts(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """lang, word and n of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for coded, lang, langs, _ in _chunks(batches, 2 * TEXT):
            size = max(1, len(coded.dictionary))
            pair, n = np.unique(lang.astype(np.int64) * size + coded.indices.to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(pair // size)), coded.dictionary.take(pa.array(pair % size)).cast(pa.string()), pa.array(n)], names=["lang", "word", "n"])

    counts = _prepared(docs, lang_column, text_column).mapInArrow(run, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def hot_words(counts: DataFrame, hot: int = HOT) -> set[int]:
    """Hashes of words that make up over 1 / ``hot`` of all: at most ``hot`` numbers. A clash only routes deeper."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    words = counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") * hot > total)
    return {r[0] for r in words.select(F.crc32(F.col("word").cast("binary"))).collect()}


def routed(docs: DataFrame, hot: set[int], buckets: int, longest: int, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """bucket, lang, depth (words that route them), suffixes (words joined by blanks) and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for coded, lang, langs, piece in _chunks(batches, TEXT):
            columns = suffixes(coded.indices.to_numpy(), piece, longest)
            pointers, n = combined([lang, *columns], np.ones(len(lang), np.int64))
            if not len(pointers):
                continue
            hashes = np.fromiter((zlib.crc32(w.encode()) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
            frequent = np.isin(hashes, np.fromiter(hot, np.uint64, len(hot)))
            route = np.fromiter((zlib.crc32(w.encode()) for w in langs.to_pylist()), np.uint64, len(langs))[lang[pointers]]
            depth, leading = np.zeros(len(pointers), np.int64), np.ones(len(pointers), bool)
            for k in range(longest):
                here = columns[k][pointers]
                depth += leading
                # Also behind a piece's end: all suffixes that begin with frequent words only go one word deeper.
                route = np.where(leading & (here >= 0), route * np.uint64(0x9E3779B97F4A7C15) + hashes[here], route)
                leading = leading & (here >= 0) & frequent[here]
            bucket = ((route ^ (route >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)
            kind = (bucket * len(langs) + lang[pointers]) * (longest + 1) + depth
            order = np.argsort(kind, kind="stable")
            pointers, kind = pointers[order], kind[order]
            fresh = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
            size = np.diff(np.append(fresh, len(kind)))
            # Arrays of TOGETHER suffixes at most, each of one bucket, lang and depth.
            parts = -(-size // TOGETHER)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            begins = np.repeat(fresh, parts) + nth * TOGETHER
            offsets = pa.array(np.append(begins, len(kind)).astype(np.int32))
            about = kind[begins]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(about // (longest + 1) // len(langs)), langs.take(pa.array(about // (longest + 1) % len(langs))), pa.array((about % (longest + 1)).astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, _joined(coded.dictionary, columns, pointers)), pa.ListArray.from_arrays(offsets, pa.array(n[order])),
                ],
                names=["bucket", "lang", "depth", "suffixes", "numbers"],
            )

    return _prepared(docs, lang_column, text_column).mapInArrow(run, "bucket long, lang string, depth int, suffixes array<string>, numbers array<long>")


class Suffixes:
    """Rows of a bucket as arrays: numbers of lang and words (with their texts), route depth and weight."""

    def __init__(self, batches: list[pa.RecordBatch], longest: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        lists = rows.column("suffixes").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        split = pc.split_pattern(lists.flatten(), " ")
        words = split.value_lengths().to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        flat, first = coded.indices.to_numpy(zero_copy_only=False), np.cumsum(words) - words
        self.lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False), sizes)
        self.depth = np.repeat(rows.column("depth").to_numpy(), sizes)
        self.weight = rows.column("numbers").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.langs, self.words, self.columns = langs.dictionary, coded.dictionary, []
        for k in range(longest):
            column = np.full(len(words), -1, np.int32)
            column[words > k] = flat[first[words > k] + k]
            self.columns.append(column)

    def merged(self, bucket: int) -> pa.RecordBatch:
        """Equal suffixes as one."""
        pointers, n = combined([self.lang, self.depth, *self.columns], self.weight)
        one = pa.array(np.arange(len(pointers) + 1, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(pointers), bucket)), self.langs.take(pa.array(self.lang[pointers])), pa.array(self.depth[pointers], pa.int32()),
                pa.ListArray.from_arrays(one, _joined(self.words, self.columns, pointers)), pa.ListArray.from_arrays(one, pa.array(n)),
            ],
            names=["bucket", "lang", "depth", "suffixes", "numbers"],
        )

    def phrases(self, least: int) -> Iterator[pa.RecordBatch]:
        """lang, phrase and n of 2 words or more; the bucket holds whole routes."""
        longest = len(self.columns)
        for depth in np.unique(self.depth).tolist():
            rows = np.flatnonzero(self.depth == depth)
            part = [self.lang[rows], *(c[rows] for c in self.columns)]
            # Phrases that the route does not hold whole are parts of sums: none may be abandoned.
            for whole in (True, False) if depth > 2 else (True,):
                found = list(equal_partitions(part, self.weight[rows], least if whole else 1))
                for size in range(2, longest + 1):
                    hits = [(p, w) for at, p, w in found if at == size + 1 and (size >= depth) == whole]
                    if hits:
                        pointers = rows[np.concatenate([p for p, _ in hits])]
                        phrase = _joined(self.words, self.columns[:size], pointers)
                        yield pa.RecordBatch.from_arrays([self.langs.take(pa.array(self.lang[pointers])), phrase, pa.array(np.concatenate([w for _, w in hits]))], names=["lang", "phrase", "n"])


def phrase_counts(rows: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, phrase and n of phrases of 2 .. ``longest`` words with ``least`` occurrences or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit, last = [], 0, 4 * POINTERS, None
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            edges = np.flatnonzero(np.diff(buckets)) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(buckets)], strict=True):
                if begin == end:
                    continue
                if buckets[begin] != last and held:
                    yield from Suffixes(held, longest).phrases(least)
                    held, size, limit = [], 0, 4 * POINTERS
                last = buckets[begin]
                part = batch.slice(begin, end - begin)
                held.append(part)
                size += pc.sum(pc.list_value_length(part.column("suffixes"))).as_py()
                if size >= limit:
                    held = [Suffixes(held, longest).merged(last)]
                    size = held[0].num_rows
                    limit = max(4 * POINTERS, 2 * size)
        if held:
            yield from Suffixes(held, longest).phrases(least)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(run, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


SCORE = """CAST(CAST(a AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0)) AS DECIMAL(38, 0)) * 1000000
    div CAST(CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)) AS DECIMAL(38, 0))"""
"""floor(1000000 a a / (l r)), exact."""


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, lang_column: str = "lang", text_column: str = "text", hot: int = HOT) -> DataFrame:
    """lang, phrase, a (its count), l and r (counts of both parts at the lowest-scoring cut), n (words of the lang) and score.

    Candidates have 2 .. ``longest`` words and ``least`` occurrences; one that lies inside a longer
    candidate with ``inside`` percent of its occurrences is dropped.
    """
    words = written(word_counts(docs, lang_column, text_column), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    buckets = 1 + (words.agg(F.sum("n")).first()[0] or 0) // POINTERS
    suffix_rows = routed(docs, hot_words(words, hot), buckets, longest, lang_column, text_column)
    phrases = written(phrase_counts(suffix_rows, longest, least), "phrase-counts")
    counts = phrases.unionByName(words.filter(F.col("n") >= least).withColumnRenamed("word", "phrase"))

    parts = phrases.withColumn("w", F.split("phrase", " "))
    piece = lambda begin, size: F.array_join(F.slice("w", begin, size), " ")
    at = F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")
    cuts = parts.select("lang", "phrase", "n", "w", at)
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", piece(F.lit(1), F.col("k")).alias("first"), piece(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", F.expr(SCORE))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Every shorter run of words inside a longer candidate, with the largest count of those.
    spans = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), b -> array_join(slice(w, b, m), ' '))))")
    longer = parts.filter(F.size("w") > 2).select("lang", F.col("n").alias("outer"), F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    open_ones = lowest.join(longer, ["lang", "phrase"], "left").filter(f"outer IS NULL OR 100 * outer < {int(inside)} * a")
    return open_ones.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", F.col("words").alias("n"), "cut.score")


def best_phrases(found: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` of each lang, with their rank; a lang is thinned in 64 parts before it meets in one task."""
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    some = Window.partitionBy("lang", "part").orderBy(*order)
    thinned = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    ranked = thinned.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
