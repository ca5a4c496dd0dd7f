"""Near duplicates by SuperMinHash signatures, banding, verification and components.

* Texts with equal shingle sets form one class; everything below works on classes, so a
  group of copies costs one row per task, however large it is.
* SuperMinHash gives every shingle a random order of the slots; its value in the j-th of
  them is j plus a random fraction, so values within a signature are correlated and
  a text stops as soon as all slots hold values below the next j.
* ``BANDS`` bands of ``ROWS`` slots: a pair at similarity 0.8 shares none with
  probability (1 - 0.8**6)**40 = 5e-6. Buckets have no cap.
* Members of a bucket are compared first with its most central one, which meets most others
  over all bands. Buckets that then still
  hold several components are compared across components, block by block: a task gets two
  blocks of about ``BLOCK_BYTES`` and gives out confirmed links that join components.
* Every link is confirmed on the full shingle sets.
* Components: labels fall to the smallest in reach, with pointer jumping.

Defined results: null texts and texts without words have no shingles and link with nothing;
null identifiers are ignored when the smallest is taken (a component of nulls has null);
repeated rows share a class; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.shingles import Polynomial, mix, shingle_sets
from episodica.llm.tables import keyed, only, slices, text_or_empty, written

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 6
BLOCK_BYTES = 16 << 20
SURE = 0.12
"""A pair whose estimate is this far below the threshold (4.6 standard errors) is no link."""
STEP = np.uint64(0x9E3779B97F4A7C15)


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures, a row per set: slot values j * 2**40 + fraction, the largest number for empty sets."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    if not sizes.sum():
        return out
    element, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = None
    with np.errstate(over="ignore"):
        for j in range(slots):
            draw = mix(element + np.uint64(j + 1) * STEP)
            pick = j + ((draw & np.uint64(0xFFFFFF)) * np.uint64(slots - j) >> np.uint64(24)).astype(np.int64)
            slot = pick if order is None else order[np.arange(len(pick)), pick]
            np.minimum.at(out, (owner, slot), (np.uint64(j) << np.uint64(40)) | (draw >> np.uint64(24)))
            # Early stop: texts whose slots are all filled leave; later values would be larger.
            full = (out != np.iinfo(np.uint64).max).all(axis=1)
            stay = ~full[owner]
            if not stay.any():
                break
            element, owner, pick = element[stay], owner[stay], pick[stay]
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(pick), 1))
            elif not stay.all():
                order = order[stay]
            # The slot used now changes places with the one at position j.
            order[np.arange(len(pick)), pick] = order[:, j]
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        cut = signatures[:, : bands * rows].reshape(len(signatures), bands, rows)
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * STEP, cut.shape[:2]).copy()
        for r in range(rows):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + cut[:, :, r])
    return key.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=12).digest()


def signed(docs: DataFrame, words: int, bands: int, rows: int, id_column: str, text_column: str) -> DataFrame:
    """id, n_shingles, cls (null for empty sets), and once per class and task its sketch and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial, done = Polynomial(), set()
        for batch, texts in slices(batches, 1):
            sets = shingle_sets(texts, words, polynomial)
            keys = [set_key(s) if len(s) else None for s in sets]
            # Equal sets of one task once, as far as it remembers.
            new = [i for i, k in enumerate(keys) if k is not None and k not in done and not done.add(k)]
            if len(done) > 500_000:
                done.clear()
            found = super_minhash([sets[i] for i in new], bands * rows)
            sketch = (mix(found) & np.uint64(0xFFFF)).astype("<u2")
            sketches, bandwise = [None] * len(sets), [None] * len(sets)
            for i, one, keys_of in zip(new, sketch, band_keys(found, bands, rows), strict=True):
                sketches[i], bandwise[i] = one.tobytes(), keys_of
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), pa.array(bandwise, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "cls", "sketch", "bands"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, f"id {kind}, n_shingles long, cls binary, sketch binary, bands array<bigint>")


def class_texts(docs: DataFrame, words: int, text_column: str) -> DataFrame:
    """cls and text, once per class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial, done = Polynomial(), set()
        for batch, texts in slices(batches, 0):
            keys = [set_key(s) if len(s) else None for s in shingle_sets(texts, words, polynomial)]
            new = [i for i, k in enumerate(keys) if k is not None and k not in done and not done.add(k)]
            if len(done) > 500_000:
                done.clear()
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in new], pa.binary()), batch.column(0).take(pa.array(new, pa.int64()))], names=["cls", "text"])

    return docs.select(text_or_empty(text_column).alias("text")).mapInArrow(run, "cls binary, text string")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough; ``texts`` has one text per class."""
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    percent = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial = Polynomial()
        for batch, texts in slices(batches, 2, 1_000_000):
            left, right = shingle_sets(texts, words, polynomial), shingle_sets(batch.column(3).to_pylist(), words, polynomial)
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)], np.int64)
            union = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.int64) - common
            yield batch.select(["a", "b"]).filter(pa.array(100 * common >= percent * union))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """node and label: the smallest node in reach, for every node of a link."""
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("low"), F.col("label").alias("was"))
        # Pointer jumping: a node takes the label of its label.
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("further"))
        step = lower.join(jump, "low", "left").select("node", F.least("low", F.coalesce("further", "low")).alias("label"), "was")
        step = written(step, "labels")
        labels = step.select("node", "label")
        if step.filter("label != was").isEmpty():
            return labels


def class_sets(texts: DataFrame, words: int) -> DataFrame:
    """cls and its full shingle set, packed; ``texts`` has one text per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial = Polynomial()
        for batch, chunk in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(chunk, words, polynomial)], pa.binary())], names=["cls", "packed"])

    return texts.select("cls", "text").mapInArrow(run, "cls binary, packed binary")


def across(buckets: DataFrame, similarity: float) -> DataFrame:
    """Confirmed links between different components of a bucket: one task gives out a forest, never all pairs.

    ``buckets`` has key, cls, label, n, sketch, bands and the packed set, and only buckets
    with several labels. Members are dealt to blocks of about ``BLOCK_BYTES`` by hash; each
    pair of blocks is compared in one task, each pair of members in the first band they share.
    """
    blocks = buckets.groupBy("key").agg(F.ceil(F.sum(F.col("n") * 8 + 1000) / BLOCK_BYTES).alias("blocks"))
    placed = buckets.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "cls", "label", "n", "sketch", "bands", "packed")
    percent = round(similarity * 100)

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("cls", ignore_index=True)
        sketch = np.stack([np.frombuffer(s, "<u2") for s in part["sketch"]])
        bands = np.stack(part["bands"].to_list())
        sets = [np.frombuffer(s, np.uint64) for s in part["packed"]]
        size, block = part["n"].to_numpy(), part["block"].to_numpy()
        _, label = np.unique(part["label"].to_numpy(), return_inverse=True)
        band = int(np.flatnonzero(bands[0] == part["key"].iloc[0])[0])
        links, diagonal = [], part["x"].iloc[0] == part["y"].iloc[0]
        for i in range(len(part) - 1):
            rest = slice(i + 1, None)
            open_ = (label[rest] != label[i]) & (100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i]))
            if not diagonal:
                open_ &= block[rest] != block[i]
            at = i + 1 + np.flatnonzero(open_)
            at = at[(sketch[at] == sketch[i]).mean(axis=1) >= similarity - SURE]
            at = at[~(bands[at, :band] == bands[i, :band]).any(axis=1)]
            for j in at:
                if label[j] != label[i]:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (size[i] + size[j] - both):
                        links.append((part["cls"][i], part["cls"][j]))
                        label[label == label[j]] = label[i]
        return pd.DataFrame(links, columns=["a", "b"])

    return dealt.groupBy("key", "x", "y").applyInPandas(compare, "a binary, b binary").distinct()


def near_classes(docs: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept of every row."""
    here = written(signed(docs, words, bands, rows, id_column, text_column), "signed")
    # Sketches and keys are functions of the class: any of its rows will do.
    once = here.filter("bands IS NOT NULL").groupBy("cls")
    classes = written(once.agg(F.any_value("n_shingles").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value("bands").alias("bands")), "classes")
    banded = classes.select("cls", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    met = written(banded.join(shared, "key").select("key", "cls", "members"), "met")
    # The text that the variants come from meets most others: stars around it leave little apart.
    central = met.groupBy("cls").agg(F.sum("members").alias("meets"))
    roots = met.join(central, "cls").groupBy("key").agg(F.max(F.struct("meets", "cls")).alias("top")).select("key", F.col("top.cls").alias("root"))
    buckets = written(met.join(roots, "key").select("key", "cls", "root"), "buckets")

    several = buckets.select("cls").distinct()
    texts = written(class_texts(docs, words, text_column).join(several, "cls", "left_semi").groupBy("cls").agg(F.any_value("text").alias("text")), "bucket-texts")

    stars = buckets.filter("cls != root").select(F.col("root").alias("a"), F.col("cls").alias("b")).distinct()
    sketches = classes.select("cls", "n", "sketch")
    stars = written(likely(stars, sketches, similarity), "stars")
    links = written(confirmed(stars, texts, words, similarity), "confirmed")
    labels = components(links)

    # What the stars left apart: buckets that still hold several components.
    named = buckets.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", F.coalesce("label", "cls").alias("label"))
    open_keys = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("key")
    in_open = named.join(open_keys, "key")
    sets = class_sets(texts.join(in_open.select("cls").distinct(), "cls", "left_semi"), words)
    open_buckets = in_open.join(classes, "cls").join(sets, "cls")
    more = written(across(open_buckets, similarity), "across")
    labels = components(links.union(more))

    found = here.select("id", "n_shingles", "cls").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    smallest = found.filter("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("component_id"))
    joined = found.join(smallest, "label", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select("id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def likely(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose sketches agree nearly as often as it asks."""
    left = sketches.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sketches.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b").filter(F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("s_a", "s_b")]
            yield batch.select(["a", "b"]).filter(pa.array((sides[0] == sides[1]).mean(axis=1) >= similarity - SURE))

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a binary, b binary")


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One row of each component, that with the smallest identifier, with all its columns."""
    rows = keyed(docs, id_column)
    found = near_classes(rows.select("key", F.col(f"row.`{text_column}`").alias("text")), id_column="key", text_column="text", **settings)
    return only(rows, found.filter("kept"))
