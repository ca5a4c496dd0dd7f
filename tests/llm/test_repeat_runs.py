"""A gram with very many places, few of them different."""

import hashlib
import random
from collections import Counter

from episodica.llm import repeats
from pyspark.sql import functions as F

LENGTH = 40


def removed(texts):
    """doc_id to number of removed bytes and hash of the others, from every string of LENGTH bytes."""
    raws = {i: t.encode() for i, t in texts}
    seen = Counter(r[s : s + LENGTH] for r in raws.values() for s in range(len(r) - LENGTH + 1))
    out = {}
    for i, r in raws.items():
        gone = [False] * len(r)
        for s in range(len(r) - LENGTH + 1):
            if seen[r[s : s + LENGTH]] > 1:
                gone[s : s + LENGTH] = [True] * LENGTH
        out[i] = (sum(gone), hashlib.sha256(bytes(b for b, g in zip(r, gone, strict=True) if not g)).hexdigest())
    return out


def test_equal_places_of_a_hot_gram_count_once(spark, monkeypatch):
    draw = random.Random(5)
    word = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    texts = [(i, word(draw.randrange(90)) + "it was " * draw.randrange(3, 60) + word(draw.randrange(90))) for i in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)

    def refuse(*_):
        raise AssertionError("strings were counted one by one")

    monkeypatch.setattr(repeats, "agreeing_by_count", refuse)
    found = repeats.without_repeats(docs, length=LENGTH, gram=8, group=150).collect()
    assert {r["id"]: (r["n_removed"], r["kept_sha256"]) for r in found} == removed(texts)


def test_rows_of_a_hot_key_do_not_meet_in_one_task(spark):
    found = [(5, i) for i in range(300)] + [(i % 40 + 100, i) for i in range(80)] + [(i + 1000, i) for i in range(50)]
    rest, hot = repeats.recurring(spark.createDataFrame(found, "gram long, place long").repartition(3), ["gram"], 100, "hot-keys")
    assert sorted((r["gram"], r["place"], r["hot"]) for r in rest.collect()) == sorted((*r, False) for r in found[300:380])
    parts = hot.groupBy(F.spark_partition_id()).agg(F.count("*"), F.countDistinct("place"), F.min("gram"), F.max("gram"), F.every("hot")).collect()
    assert sum(r[1] for r in parts) == sum(r[2] for r in parts) == 300 and {tuple(r)[3:] for r in parts} == {(5, 5, True)}
    assert len(parts) == 3 and max(r[1] for r in parts) < 150
    assert repeats.recurring(rest.select("gram"), ["gram"], 100, "hot-keys")[1] is None


def test_halves_shared_by_too_many_places(spark):
    draw = random.Random(6)
    word = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    texts = [(i, word(draw.randrange(60)) + "it was " * draw.randrange(3, 30) + word(draw.randrange(60))) for i in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = repeats.without_repeats(docs, length=LENGTH, gram=8, group=4).collect()
    assert {r["id"]: (r["n_removed"], r["kept_sha256"]) for r in found} == removed(texts)
