"""Removal of every byte covered by a string of ``LENGTH`` bytes that starts anywhere else.

* Every string of LENGTH bytes holds the smallest of its grams (hashes of ``GRAM`` bytes),
  the leftmost if equal; so two equal strings share an anchor at the same offset. About two
  anchors stand in LENGTH bytes, and only anchors whose gram occurs again go on.
* The places of a gram, with the bytes before and from them on, come together. Equal
  surroundings are one; the others are sorted from the place on and backwards (deep-shallow
  sorting), and the sorted orders tell how far each place agrees with some other.
* Of a gram with over ``GROUP`` places those with the same surroundings (their hash) are told
  first and one stands for all: a run that repeats a word has many places, few of them different.
  A gram with over ``GROUP`` different ones never meets in one task. Two places that agree on
  LENGTH bytes agree on half of them before or behind the gram, so its places are dealt to groups
  by a hash of either half; a place that shares neither goes no further. Groups are sorted like
  grams. Only where over ``GROUP`` different places share a half as well, strings are counted
  by their hash, combined before the shuffle.
* Equal texts have one key and take part once; a text with an equal other is covered whole.

Defined results: null and empty texts have nothing to remove; repeated rows are equal texts;
texts below LENGTH bytes stay; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.shingles import Polynomial
from episodica.llm.suffix_sort import reaches
from episodica.llm.tables import slices, text_or_empty, written

LENGTH, GRAM = 400, 32
GROUP = 100_000
"""Places of a gram that meet in one task: at most GROUP * 2 * LENGTH bytes, 80 MB."""
SEGMENT = 1 << 20
WHOLE = 2**31 - 1


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchors(texts: list[bytes], length: int, gram: int, polynomial: Polynomial) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and grams of each text's anchors; together the texts have at most SEGMENT bytes."""
    begins = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    prefix = polynomial.prefix(data)
    at = np.arange(len(data) - gram + 1)
    grams = polynomial.numbers(prefix, at, at + gram)
    # The position in the low bits makes equal grams differ, the leftmost first.
    marked = (grams & ~np.uint64(SEGMENT - 1)) | at.astype(np.uint64)
    least = sliding_minimum(marked, length - gram + 1)
    inside = np.zeros(len(data) + 1, np.int32)
    long = np.diff(begins) >= length
    np.add.at(inside, begins[:-1][long], 1)
    np.add.at(inside, begins[1:][long] - length + 1, -1)
    chosen = np.zeros(len(data), bool)
    chosen[(least[np.cumsum(inside)[: len(least)] > 0] & np.uint64(SEGMENT - 1)).astype(np.int64)] = True
    places = np.flatnonzero(chosen)
    cuts = np.searchsorted(places, begins)
    return [(places[a:b] - begin, grams[places[a:b]].view(np.int64)) for a, b, begin in zip(cuts[:-1], cuts[1:], begins[:-1], strict=True)]


def long_anchors(text: bytes, length: int, gram: int, polynomial: Polynomial) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a text of any length: segments overlap, so that each string lies whole in one."""
    found = {}
    for begin in range(0, max(1, len(text) - length + 1), SEGMENT - length):
        places, grams = anchors([text[begin : begin + SEGMENT]], length, gram, polynomial)[0]
        found |= dict(zip((places + begin).tolist(), grams.tolist(), strict=True))
    return np.array(sorted(found), np.int64), np.array([found[p] for p in sorted(found)], np.int64)


def text_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """key of the text, positions and grams of its anchors; equal texts of a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial, done = Polynomial(), set()
        for _, texts in slices(batches, 0, SEGMENT // 4):
            raws = {hashlib.md5(raw).digest(): raw for t in texts if len(raw := t.encode()) >= length}
            raws = {k: raw for k, raw in raws.items() if k not in done}
            if len(done) > 500_000:
                done.clear()
            done.update(raws)
            if sum(map(len, raws.values())) <= SEGMENT:
                found = anchors(list(raws.values()), length, gram, polynomial)
            else:
                found = [long_anchors(raw, length, gram, polynomial) for raw in raws.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(raws), pa.binary()), pa.array([p for p, _ in found], pa.list_(pa.int64())), pa.array([g for _, g in found], pa.list_(pa.int64()))], names=["key", "places", "grams"]
            )

    return docs.select("text").mapInArrow(run, "key binary, places array<bigint>, grams array<bigint>")


def surroundings(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """gram, hot, key, place and the bytes before (nearest first) and from it on. ``rows`` has key, text and spots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch, texts in slices(batches, 1):
            out = []
            for key, text, spots in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True):
                if key == last:
                    # Rows of equal texts come one after the other.
                    continue
                last, raw = key, text.encode()
                for spot in spots:
                    at = spot["place"]
                    out.append((spot["gram"], spot["hot"], key, at, raw[max(0, at - length + gram) : at][::-1], raw[at : at + length]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["gram", "hot", "key", "place", "left", "right"])

    return rows.select("key", "text", "spots", "id").mapInArrow(run, "gram long, hot boolean, key binary, place long, left binary, right binary")


def faces(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """gram, key, place, how many bytes lie back and forth, the hash of all of them, and those of LENGTH / 2 bytes before and from the place on."""
    half = (length + 1) // 2

    def digest(part: bytes) -> bytes:
        return hashlib.blake2b(part, digest_size=12).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch, texts in slices(batches, 1):
            out = []
            for key, text, spots in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True):
                if key == last:
                    continue
                last, raw = key, text.encode()
                for spot in spots:
                    at = spot["place"]
                    left, right = raw[max(0, at - length + gram) : at], raw[at : at + length]
                    sides = [digest(part) if len(part) == half else None for part in (raw[max(0, at - half) : at], right[:half])]
                    # The length tells where the place lies in the bytes.
                    out.append((spot["gram"], key, at, len(left), len(right), digest(len(left).to_bytes(4) + left + right), *sides))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["gram", "key", "place", "back", "forth", "whole", "before", "after"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return rows.select("key", "text", "spots", "id").mapInArrow(run, "gram long, key binary, place long, back int, forth int, whole binary, before binary, after binary")


def agreeing(near: DataFrame, length: int) -> DataFrame:
    """key, begin and end of what each place shares with another; ``near`` comes grouped by gram."""

    def settle(rows: list[tuple]) -> Iterator[tuple[bytes, int, int]]:
        members: dict[tuple[bytes, bytes], dict] = {}
        for _, key, place, left, right in rows:
            members.setdefault((left, right), {})[key, place] = None
        sides = list(members)
        found = reaches([s[0] for s in sides], [s[1] for s in sides], length) if len(sides) > 1 else [(0, 0)] * len(sides)
        for side, (back, forth) in zip(sides, found, strict=True):
            places = members[side]
            if len(places) > 1 and len(side[0]) + len(side[1]) >= length:
                back, forth = len(side[0]), len(side[1])
            if forth:
                yield from ((key, place - back, place + forth) for key, place in places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def pack(out):
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["key", "begin", "end"])

        out = []
        for _, group in groupby(rows(), key=lambda r: r[0]):
            out += settle(list(group))
            if len(out) > 20_000:
                yield pack(out)
                out = []
        if out:
            yield pack(out)

    return near.select("gram", "key", "place", "left", "right").mapInArrow(run, "key binary, begin long, end long")


def agreeing_by_count(near: DataFrame, length: int) -> DataFrame:
    """The same for grams with many places: strings at every offset are counted by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, key, place, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                whole, at = left[::-1] + right, len(left)
                starts = range(0, min(at, len(whole) - length) + 1)
                hashes = [hashlib.blake2b(whole[s : s + length], digest_size=12).digest() for s in starts]
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gram] * n, pa.int64()), pa.array([at - s for s in starts], pa.int64()), pa.array(hashes, pa.binary()), pa.array([key] * n, pa.binary()), pa.array([place] * n, pa.int64())],
                    names=["gram", "offset", "hash", "key", "place"],
                )

    strings = written(near.select("gram", "key", "place", "left", "right").mapInArrow(run, "gram long, offset long, hash binary, key binary, place long").dropDuplicates(["offset", "key", "place", "gram"]), "strings")
    again = strings.groupBy("gram", "offset", "hash").count().filter("count > 1").drop("count")
    return strings.join(again, ["gram", "offset", "hash"]).select("key", (F.col("place") - F.col("offset")).alias("begin"), (F.col("place") - F.col("offset") + length).alias("end"))


def recurring(rows: DataFrame, columns: list[str], group: int, name: str, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Those rows whose ``columns`` occur again, and apart from them those that share theirs with over ``group`` rows; ``hot`` tells which.

    Of the latter (None if there are none) none moves, so no task gathers the rows of one of them.
    ``counted`` has the same ``columns`` as ``rows`` where they are read more cheaply.
    """
    again = (rows if counted is None else counted).groupBy(columns).count().filter("count > 1")
    crowded = written(again.filter(F.col("count") > group).select(columns), name)
    few, again = F.broadcast(crowded), again.select(columns)
    if crowded.isEmpty():
        return rows.join(again, columns).withColumn("hot", F.lit(False)), None
    # Each of the few stands for over ``group`` rows.
    rest = rows.join(few, columns, "left_anti").join(again, columns)
    return rest.withColumn("hot", F.lit(False)), rows.join(few, columns).withColumn("hot", F.lit(True))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """key and spans (begin, end) of texts with repeated strings. ``docs`` has id, text and the text's key."""
    found = text_anchors(docs, length, gram)
    once = written(found.groupBy("key").agg(F.any_value("places").alias("places"), F.any_value("grams").alias("grams")), "anchors")
    spots = once.select("key", F.explode(F.arrays_zip("places", "grams")).alias("s")).select("key", F.col("s.places").alias("place"), F.col("s.grams").alias("gram"))
    rare, hot = recurring(spots, ["gram"], group, "hot", once.select(F.explode("grams").alias("gram")))

    def placed(chosen: DataFrame) -> DataFrame:
        wanted = chosen.groupBy("key").agg(F.collect_list(F.struct("place", "gram", "hot")).alias("spots"))
        # All columns of ``docs`` go in, so that this join and the caller's share one exchange of texts.
        return docs.join(wanted, "key")

    def sorted_spans(chosen: DataFrame) -> DataFrame:
        return agreeing(surroundings(placed(chosen), length, gram).repartition("gram").sortWithinPartitions("gram"), length)

    spans = sorted_spans(rare)
    if hot is not None:
        every = written(faces(placed(hot), length, gram), "faces")
        at = F.struct("key", "place")
        different = every.groupBy("gram", "whole").agg(
            F.min(at).alias("first"), F.max(at).alias("last"), *[F.any_value(c).alias(c) for c in ("back", "forth", "before", "after")]
        )
        different = written(different, "different")
        equal = different.filter((F.col("first") != F.col("last")) & (F.col("back") + F.col("forth") >= length)).select("gram", "whole")
        spans = spans.union(
            every.join(equal, ["gram", "whole"]).select("key", (F.col("place") - F.col("back")).alias("begin"), (F.col("place") + F.col("forth")).alias("end"))
        )
        # One place stands for all with the same surroundings.
        many = different.groupBy("gram").count().select("gram", (F.col("count") > group).alias("hot"))
        # There are as few of them as there are hot grams.
        ones = different.select("gram", "first.key", "first.place", "before", "after").join(F.broadcast(many), "gram")
        spans = spans.union(sorted_spans(ones.filter("NOT hot").select("key", "place", "gram", "hot")))
        if not many.filter("hot").isEmpty():
            sides = ones.filter("hot").select("gram", "key", "place", F.posexplode(F.array("before", "after")).alias("side", "hash"))
            sides = written(sides.filter("hash IS NOT NULL"), "halves")
            # A clash of numbers puts groups together; bytes are compared there.
            numbered = sides.select("key", "place", F.xxhash64("gram", "side", "hash").alias("gram"))
            shared, crowded = recurring(numbered, ["gram"], group, "halved")
            spans = spans.union(sorted_spans(shared))
            if crowded is not None:
                spans = spans.union(agreeing_by_count(surroundings(placed(crowded), length, gram), length))
    copies = docs.groupBy("key").count().filter("count > 1").select("key", F.lit(0).cast("long").alias("begin"), F.lit(WHOLE).cast("long").alias("end"))
    return spans.union(copies).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP, keep_bytes: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, the kept bytes (null unless ``keep_bytes``) and their sha256."""
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    # Never null; said here, so that both joins below ask for the same exchange.
    rows = rows.filter("key IS NOT NULL")
    spans = repeated_spans(rows, length, gram, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 1):
            out = []
            for text, spans in zip(texts, batch.column(2).to_pylist(), strict=True):
                raw, kept, at, n = text.encode(), [], 0, 0
                end = -1
                for span in sorted((s["begin"], min(s["end"], len(raw))) for s in spans or () if len(raw) >= length):
                    if span[0] > end:
                        kept.append(raw[at : span[0]])
                        n += 1
                    end = at = max(end, span[1])
                kept.append(raw[at:])
                kept = b"".join(kept)
                out.append((len(raw), len(raw) - len(kept), n, kept if keep_bytes else None, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    kind = docs.schema[id_column].dataType.simpleString()
    joined = rows.join(spans, "key", "left").select("id", "text", "spans")
    return joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
