"""Spelling variants: words that differ by exactly one inserted, deleted or replaced character.

The vocabulary is scanned in sorted order. Neighbours in it share a prefix, so the rows of the
edit matrix (a band of three cells, as only one edit counts) of that prefix are made once for
the whole range of words behind it, and a range whose shared prefix is already more than one
edit away is skipped. The scan goes one character deeper at a time, for many groups of
words at once in arrays.

No word is compared with the whole vocabulary. Of two near words, the shorter with s
characters, the first or the last s // 2 characters are equal: a group holds
words of s and s + 1 characters that share that many at the front, or at the back. What
lies between obeys the same rule, so a group of over ``GROUP`` words is cut again by half
of the rest, in front or behind, until it is small or one character is left between (then
the alphabet bounds it). A pair is counted in the first of its groups only: the others hold
``below``, the shared prefix that they leave to it.

Defined results: null and empty texts have no words; a null identifier is an empty one; repeated
rows count each; a word without near words has no form and is its own root; an empty table
gives an empty table. A word of any length is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.tables import text_or_empty, written

RUNS = "[A-Za-zÀ-ÿ]+"
GROUP = 20_000
"""Words of a group that are scanned together."""
CELLS = 4_000_000
"""Characters of the words that one scan holds, one word of each group at least."""
QUERIES = 4_000
"""Words whose bands are kept at once."""


def words_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", pattern: str = RUNS) -> DataFrame:
    """id and word: every run of letters, A-Z in lower case."""
    text = F.translate(text_or_empty(text_column), ascii_uppercase, ascii_lowercase)
    return docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(pattern), 0)).alias("word"))


def planted(words: DataFrame, one_in: int) -> DataFrame:
    """The words, one in ``one_in`` of them without one character; a hash of identifier and word picks both."""
    picked = F.crc32(F.concat("id", F.lit(":"), "word"))
    at = (picked % F.length("word")).cast("int")
    # substr with an open end copies the rest.
    shorter = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
    return words.select(F.when(picked % one_in == 0, shorter).otherwise(F.col("word")).alias("word"))


def counted(words: DataFrame, length: int, least: int) -> DataFrame:
    """word and n of words with ``length`` characters and ``least`` occurrences or more."""
    return words.filter(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _cut(rows: DataFrame) -> DataFrame:
    """Two groups of each row of a group (s, front, back, below): by more of the front, and by more of the back."""
    rest = F.col("s") - F.col("front") - F.col("back")
    more = F.floor(rest / 2).cast("int")
    before = F.struct("s", (F.col("front") + more).alias("front"), "back", "below")
    behind = F.struct("s", "front", (F.col("back") + more).alias("back"), F.least("below", F.col("front") + more).alias("below"))
    cut = rows.select("word", "n", F.explode(F.array(before, behind)).alias("g")).select("word", "n", "g.*")
    return cut.filter("front < below").withColumns({"head": F.substring("word", F.lit(1), F.col("front")), "tail": F.expr("right(word, back)")})


KEY = ["s", "front", "back", "below", "head", "tail"]


def grouped(vocabulary: DataFrame, group: int = GROUP) -> DataFrame:
    """word and n in each group where it may have near words; no group is over ``group`` unless one character is left."""
    size = F.length("word")
    start = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("s")).filter("s >= 0")
    open_rows = start.withColumns({"front": F.lit(0), "back": F.lit(0), "below": F.lit(2**31 - 1)})
    done = None
    while True:
        cut = written(_cut(open_rows), "spelling-groups")
        sizes = cut.groupBy(*KEY).agg(F.count("*").alias("members"), F.min(F.length("word")).alias("shortest")).filter("members > 1 AND shortest = s")
        # Words of one character more meet among themselves in the next class.
        placed = written(cut.join(sizes.select(*KEY, "members"), KEY), "spelling-placed")
        large = (F.col("members") > group) | (F.col("members") * F.col("s") > CELLS)
        hot = large & (F.col("s") - F.col("front") - F.col("back") >= 2)
        small = placed.filter(~hot)
        done = small if done is None else done.unionByName(small)
        open_rows = placed.filter(hot)
        if open_rows.isEmpty():
            return done


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in rows, 0 behind a word's end, and the words' lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(size.max(initial=0)) + 1), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return out, size


def near_pairs(group: np.ndarray, words: list[str], shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words one edit apart inside a group, the first always of ``shorter``, the group's smaller length.

    Rows come sorted by group (a number) and word. Pairs of two words of the smaller length
    come in both directions.
    """
    n = len(words)
    text, size = padded(words)
    width = text.shape[1]
    fresh = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, bool)
    differs = text[1:] != text[:-1]
    shared = np.concatenate([[0], np.where(differs.any(axis=1), differs.argmax(axis=1), width)]).astype(np.int64)
    shared[fresh] = -1
    starts_of_groups = np.flatnonzero(fresh)
    ends_of_groups = np.append(starts_of_groups[1:], n)
    group_at = np.cumsum(fresh) - 1
    queries = np.flatnonzero(shorter)
    left, right = [], []
    for begin in range(0, len(queries), QUERIES):
        query = queries[begin : begin + QUERIES]
        low, high = starts_of_groups[group_at[query]], ends_of_groups[group_at[query]]
        # Cells of the row for the empty prefix: query prefixes of -1, 0 and 1 characters.
        band = np.tile(np.array([9, 0, 1], np.int8), (len(query), 1))
        for depth in range(width):
            ends = size[low] == depth
            wanted = size[query] - depth
            hit = ends & (((wanted == 0) & (band[:, 1] == 1)) | ((wanted == -1) & (band[:, 0] == 1)))
            left.append(query[hit])
            right.append(low[hit])
            # The ranges of the next character; a word that ends here stands first and is left behind.
            low = low + ends
            keep = low < high
            query, low, high, band = query[keep], low[keep], high[keep], band[keep]
            if not len(query):
                break
            cuts = np.flatnonzero(shared <= depth)
            first, last = np.searchsorted(cuts, low, "right"), np.searchsorted(cuts, high)
            children = last - first + 1
            item = np.repeat(np.arange(len(query)), children)
            nth = np.arange(len(item)) - np.repeat(np.cumsum(children) - children, children)
            edge = np.append(cuts, n)
            new_low = np.where(nth == 0, low[item], edge[first[item] + nth - 1])
            new_high = np.where(nth == children[item] - 1, high[item], edge[np.minimum(first[item] + nth, len(cuts))])
            query, band = query[item], band[item]
            letter = text[new_low, depth]
            # The next row: query prefixes of depth, depth + 1 and depth + 2 characters.
            same = np.empty((len(query), 3), bool)
            for j in range(3):
                at = depth - 1 + j
                same[:, j] = (letter == text[query, min(at, width - 1)]) & (at < size[query]) & (at >= 0)
            row = np.empty_like(band)
            row[:, 0] = np.minimum(band[:, 0] + ~same[:, 0], band[:, 1] + 1)
            row[:, 1] = np.minimum(np.minimum(band[:, 1] + ~same[:, 1], band[:, 2] + 1), row[:, 0] + 1)
            row[:, 2] = np.minimum(band[:, 2] + ~same[:, 2], row[:, 1] + 1)
            keep = row.min(axis=1) <= 1
            query, low, high, band = query[keep], new_low[keep], new_high[keep], row[keep]
            if not len(query):
                break
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def settled(groups: list[tuple], rows: list[tuple[str, int]]) -> list[tuple[str, int, str, int]]:
    """word, number of near words, and the most frequent of them with its n, over whole groups.

    ``groups`` has (s, front, back, below) and the number of rows for each group in ``rows``, which come
    sorted by what lies between front and back.
    """
    group = np.repeat(np.arange(len(groups)), [g[1] for g in groups])
    s, front, back, below = (np.repeat(np.array([g[0][i] for g in groups], np.int64), [g[1] for g in groups]) for i in range(4))
    words = [w for w, _ in rows]
    middles = [w[a : len(w) - b] for w, a, b in zip(words, front.tolist(), back.tolist(), strict=True)]
    size = np.fromiter(map(len, words), np.int64, len(words))
    left, right = near_pairs(group, middles, size == s)
    if not len(left):
        return []
    # What another group has counted: pairs whose words share ``below`` characters.
    limited = np.flatnonzero(below[left] < 2**31 - 1)
    own = np.ones(len(left), bool)
    for k in limited.tolist():
        a, b, stop = words[left[k]], words[right[k]], int(below[left[k]])
        own[k] = a[:stop] != b[:stop]
    left, right = left[own], right[own]
    # Pairs of unequal length were found from the shorter word only.
    longer = size[right] > s[right]
    left, right = np.concatenate([left, right[longer]]), np.concatenate([right, left[longer]])
    best: dict[int, tuple[int, int, str]] = {}
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        word, n = rows[b]
        had = best.get(a)
        if had is None:
            best[a] = (1, n, word)
        else:
            best[a] = (had[0] + 1, *((n, word) if n > had[1] or (n == had[1] and word < had[2]) else had[1:]))
    return [(words[a], count, word, n) for a, (count, n, word) in best.items()]


def neighbours(groups: DataFrame) -> DataFrame:
    """word, n_near, and the most frequent near word with its n (ties: first in code-point order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(found):
            columns = list(zip(*found, strict=True)) if found else [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "near", "near_n"])

        keys, rows, at, longest = [], [], None, 0
        for batch in batches:
            for *key, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    if len(rows) >= GROUP or longest * len(rows) > CELLS:
                        yield pack(settled(keys, rows))
                        keys, rows, longest = [], [], 0
                    at = key
                    keys.append((key[:4], 0))
                keys[-1] = (keys[-1][0], keys[-1][1] + 1)
                rows.append((word, n))
                longest = max(longest, len(word))
        if rows:
            yield pack(settled(keys, rows))

    between = F.col("word").substr(F.col("front") + 1, F.length("word") - F.col("front") - F.col("back"))
    dealt = groups.select(*KEY, "word", "n").repartition(*KEY).sortWithinPartitions(*KEY, between)
    partial = dealt.mapInArrow(run, "word string, n_near long, near string, near_n long")
    # The smallest of (-n, word) is the most frequent near word.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of all words with a form: each jumps to the form of its form until none moves.

    A form has more occurrences than its word, so there is no circle and the rounds are few.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(vocabulary: DataFrame, ratio: int = 5, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near and form_n for a table of distinct words and their n.

    A word's form is its most frequent near word, if that has ``ratio`` times its occurrences.
    """
    vocabulary = written(vocabulary.select("word", "n"), "vocabulary")
    near = neighbours(grouped(vocabulary, group))
    known = vocabulary.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.word").alias("near"), (-F.col("best.less")).alias("near_n"))
    enough = F.col("near_n") >= ratio * F.col("n")
    known = written(known.select("word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")), "variants")
    followed = roots(known.filter("form IS NOT NULL"))
    return known.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
