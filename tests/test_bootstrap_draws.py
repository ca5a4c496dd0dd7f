"""Draws of many texts at once, and the two stages over groups of several blocks."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.functions import digests
from episodica.functions.seeds import digest_text, draw_below
from episodica.operators import bootstrap
from episodica.operators.ordered import index_block


def told(*parts):
    return "".join(f"{len(str(p))}:{p}" for p in parts)


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("text", ["", "2:42", "é" * 27, "x" * 57, "x" * 119])
def test_draws_are_those_of_the_texts(text):
    ends = np.array([0, 12, 3, 1205])
    got = []
    for which, drawn in digests.draws(text, (8, 12), told(7), 2, ends):
        got += zip(which.tolist(), drawn.tolist(), strict=True)
    want = [(r, number(text + told(8 + r, 7, i))) for r in range(4) for i in range(2, ends[r])]
    assert sorted(got) == sorted(want)


def test_draws_agree_with_the_columns(spark):
    row = spark.range(1).select(draw_below(F.md5(digest_text(F.lit("42"), F.lit(13), F.lit(250))), F.lit(1 << 60)).alias("n"))
    ((_, drawn),) = list(digests.draws(told(42), (13, 14), "", 250, np.array([251])))
    assert row.first().n == drawn[0]


def test_two_stages_of_groups_with_several_blocks(spark, monkeypatch):
    # Units of several replicates, of one replicate, and of a part of a replicate.
    sizes = {"a": 3, "b": 1500, None: 2600}
    data = [(k, i, float(i % 97), 1) for k, n in sizes.items() for i in range(n)]
    rows = spark.createDataFrame(data, "key string, episode_index long, _s double, _n long")
    monkeypatch.setattr(bootstrap, "UNIT", 4000)
    monkeypatch.setattr(bootstrap, "LONG", 1000)
    monkeypatch.setattr(bootstrap, "PART", 4)
    found = bootstrap._replicate_sums(rows, ["key"], index_block("episode_index"), 11, 42).collect()
    got = {(r.key, r.replicate): (r._s, r._n) for r in found}
    block, want = bootstrap.BLOCK, {}
    for key, size in sizes.items():
        name = "-" if key is None else told(key)
        for r in range(11):
            taken = []
            if size <= block:
                taken = [(0, size)]
            else:
                at = [number(told(42) + name + told(r, i)) % size // block for i in range(size)]
                taken = [(b, at.count(b)) for b in set(at)]
            picks = [b * block + number(told(42, "slot") + name + told(r, b, t)) % min(block, size - b * block) for b, k in taken for t in range(k)]
            want[key, r] = (sum(float(i % 97) for i in picks), float(size))
    assert got == want


def test_counts_of_blocks_are_not_sent_to_the_driver(spark, monkeypatch):
    """The sizes are broadcast, the counts derived from them are joined by shuffle."""
    rows = spark.createDataFrame([("a", i, 1.0, 1) for i in range(1500)], "key string, episode_index long, _s double, _n long")
    plans, kept = [], bootstrap.checkpointed
    monkeypatch.setattr(bootstrap, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or kept(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        bootstrap._replicate_sums(rows, ["key"], index_block("episode_index"), 3, 42)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    outer = [line for line in plans[-1].splitlines() if "LeftOuter" in line]
    assert outer and not any("Broadcast" in line for line in outer)


def test_groups_of_zeros_are_not_drawn(spark, monkeypatch):
    data = [("none", i, 0.0) for i in range(1500)] + [("some", i, float(i % 2)) for i in range(1500)] + [("part", 1, 0.0), ("part", 2, None)]
    df = spark.createDataFrame(data, "source string, episode_index long, v double")
    got = {r.source: r for r in bootstrap.cluster_bootstrap_ci(df, "v", index_block("episode_index"), 20, 1, ["source"]).collect()}
    assert (got["none"].ci95_low, got["none"].ci95_high) == (0.0, 0.0)
    assert 0.4 < got["some"].ci95_low < got["some"].ci95_high < 0.6
    # A replicate of episodes without values has no mean; the others are 0.
    assert (got["part"].ci95_low, got["part"].ci95_high) == (0.0, 0.0)
    sums = bootstrap._replicate_sums(df.groupBy("source", "episode_index").agg(F.sum("v").alias("_s"), F.count("v").alias("_n")), ["source"], index_block("episode_index"), 20, 1)
    assert {r._n for r in sums.where("source = 'none'").collect()} == {1.0}
    assert {r._n for r in sums.where("source = 'part'").collect()} <= {0.0, 1.0, 2.0}


@pytest.mark.parametrize("size", [40, 46, 50, 55, 58, 62, 101, 107, 112, 119])
@pytest.mark.parametrize("bound", [1024, 1000, 18_000_001])
def test_draws_below_a_bound_where_fields_lie_in_different_blocks(size, bound):
    """Keys of any length (A19 adds one): replicate and number in one block of md5 or in two, numbers of five digits and more."""
    text, ends = "k" * size, np.array([10_003, 0, 9_998])
    got = [(int(w), int(n)) for which, drawn in digests.draws(text, (99, 102), told(3), 9_995, ends) for w, n in zip(which, drawn, strict=True)]
    want = [(r, number(text + told(99 + r, 3, i))) for r in range(3) for i in range(9_995, ends[r])]
    assert sorted(got) == sorted(want)
    first = next(digests.digests(text, (99, 100), told(3), 10_000, ends[:1]))
    assert digests.below(*first[2:], bound).tolist() == [number(text + told(99, 3, i)) % bound for i in range(10_000, 10_003)]
