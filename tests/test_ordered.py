"""Block-wise order steps and quantiles against brute force, with one hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from episodica.operators import offsets, ordered, quantiles
from episodica.operators.plateaus import detect_plateaus
from episodica.operators.statistics import next_frame_gap, relative_action_stats


@pytest.fixture(scope="module")
def frames(spark):
    draw = random.Random(1)
    data = [("hot", i, float(draw.randint(0, 9))) for i in range(200)]
    data += [(f"e{n}", i, float(draw.randint(0, 9))) for n in range(20) for i in range(draw.randint(1, 9))]
    draw.shuffle(data)
    return spark.createDataFrame(data, "e string, t long, x double").repartition(5).cache()


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("circular", [False, True])
def test_neighbours_cross_blocks(frames, forward, circular):
    step = ordered.next_row if forward else ordered.previous_row
    got = step(frames, ["e"], ["t"], ["x", "t"], ordered.index_block("t", 4), "n_", circular)
    groups = {}
    for r in frames.collect():
        groups.setdefault(r.e, []).append((r.t, r.x))
    want = set()
    for e, members in groups.items():
        members.sort()
        for i, (t, _) in enumerate(members):
            j = i + (1 if forward else -1)
            if circular:
                j %= len(members)
            near = members[j] if 0 <= j < len(members) else (None, None)
            want.add((e, t, near[1], near[0]))
    assert {(r.e, r.t, r.n_x, r.n_t) for r in got.collect()} == want


def test_previous_and_next_share_one_exchange(spark, frames, tmp_path):
    frames.write.parquet(f"{tmp_path}/frames")
    rows = spark.read.parquet(f"{tmp_path}/frames")
    got = ordered.neighbours(rows, ["e"], ["t"], ordered.index_block("t", 4), ["x"], ["x"])
    order = Window.partitionBy("e").orderBy("t")
    want = rows.withColumns({"previous_x": F.lag("x").over(order), "next_x": F.lead("x").over(order)})
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    gaps = {(r.e, r.t): (r.gap, r.gap_delta) for r in next_frame_gap(rows, "x", "x", ["e"], ["t"], ordered.index_block("t", 4)).collect()}
    both = {(r.e, r.t): r for r in want.collect()}
    assert gaps == {
        k: (r.x - r.next_x, None if r.previous_x is None else r.x - r.next_x - (r.previous_x - r.x))
        for k, r in both.items() if r.next_x is not None
    }


def test_several_totals_at_once(frames):
    got = ordered.running_totals(frames, ["e"], ["t"], ordered.index_block("t", 4), {"sum": F.col("x"), "rows": F.lit(1)})
    assert got.columns == [*frames.columns, "sum", "rows"]
    groups = {}
    for r in got.orderBy("t").collect():
        before = groups.setdefault(r.e, [0.0, 0])
        assert (r["sum"], r["rows"]) == tuple(before)
        before[0] += r.x
        before[1] += 1


@pytest.mark.parametrize("rows_in_block", [1, 2, 5, 1000])
@pytest.mark.parametrize("vector", [False, True])
def test_runs_cross_blocks(spark, rows_in_block, vector):
    draw = random.Random(rows_in_block)
    data, want = [], set()
    for e in range(25):
        states, now = [], (0.0, 0.0)
        for _ in range(draw.randint(1, 40)):
            # Few values, so that the ends of a block often agree around another run.
            now = draw.choice([now, now, now, (1.0, 0.0), (0.0, 0.0), (0.0, 1.0)])
            states.append(now)
        actions = [[draw.random(), draw.random(), draw.random()] for _ in states]
        data += [(e, t, *s, a) for t, (s, a) in enumerate(zip(states, actions, strict=True))]
        begin, events = 0, 0
        for t in range(1, len(states) + 1):
            if t == len(states) or states[t] != states[begin]:
                if t - begin >= 3:
                    spans = [max(a[j] for a in actions[begin:t]) - min(a[j] for a in actions[begin:t]) for j in range(3)]
                    spans = (max(spans[:2]), spans[2]) if vector else (spans[0], spans[2])
                    want.add((e, events, begin, t - 1, t - begin, *spans))
                    events += 1
                begin = t
    df = spark.createDataFrame(data, "e int, t long, l double, r double, a array<double>").repartition(3)
    df = df.withColumns({"left": F.slice("a", 1, 2) if vector else F.col("a")[0], "right": F.slice("a", 3, 1) if vector else F.col("a")[2]})
    got = detect_plateaus(df, ("l", "r"), ("left", "right"), ["e"], ["t"], "t", ordered.index_block("t", rows_in_block), minimum_frames=3)
    columns = "e event_index fresh_proxy_frame plateau_end_frame plateau_frames left_action_range right_action_range".split()
    assert {tuple(r) for r in got.select(columns).collect()} == want


@pytest.mark.parametrize("n", [1, 3, 50, 10_000])
def test_first_rows_of_hot_groups(frames, n):
    got = ordered.first_rows(frames, ["e"], ["t"], ordered.index_block("t", 4), n)
    rank = F.row_number().over(Window.partitionBy("e").orderBy("t"))
    want = frames.withColumn("r", rank).where(F.col("r") <= n).drop("r")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert ordered.first_rows(frames, [], ["t", "e"], ordered.index_block("t", 4), n).count() == min(n, frames.count())


@pytest.mark.parametrize(("block", "flush"), [(65536, 2_000_000), (5, 7)])
def test_offsets_equal_all_pairs(spark, monkeypatch, block, flush):
    monkeypatch.setattr(offsets, "BLOCK_ROWS", block)
    monkeypatch.setattr(offsets, "FLUSH", flush)
    draw = np.random.default_rng(block)
    data, values = [], {}
    for e in range(12):
        n = int(draw.integers(1, 23))
        action, state = draw.normal(0, 3, (n, 2)).round(2), draw.normal(0, 3, (n, 2)).round(2)
        data += [(e, t, action[t].tolist(), [None if t == 2 else float(state[t][0]), float(state[t][1])]) for t in range(n)]
        for t in range(n - 3):
            for k in range(4):
                for j in range(2):
                    if not (t == 2 and j == 0):
                        values.setdefault((j, k), []).append(action[t + k][j] - state[t][j])
    df = spark.createDataFrame(data, "e int, t long, a array<double>, s array<double>").repartition(3)
    got = {(r.joint_index, r.k): r for r in relative_action_stats(df, "a", "s", ["e"], "t", 4).collect()}
    assert set(got) == set(values)
    for key, x in values.items():
        r = got[key]
        assert r.sample_count == len(x)
        want = [np.mean(x), np.std(x), min(x), max(x), np.quantile(x, 0.01), np.quantile(x, 0.99)]
        assert [r.mean, r.std, r.min, r.max, r.q01, r.q99] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_moments_of_cells(spark):
    draw = np.random.default_rng(8)
    groups = {"a": draw.normal(1e6, 1e-3, 500), "b": np.array([1e300, -1e300, 3.0]), "c": np.array([np.nan, np.inf, -np.inf, 2.0, 4.0]), "d": np.array([-0.0, 1e-310])}
    data = [(g, float(v)) for g, x in groups.items() for v in x] + [("e", None), ("a", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    views = {quantiles.VALUE: {"m": 0.5}, quantiles.SIZE: {"s": 0.5}}
    got = {r.g: r for r in quantiles.profile(df, ["g"], "v", views, finite=True, empty=True).collect()}
    assert set(got) == {*groups, "e"} and got["e"].moments["count"] == 0 and got["e"].m is None and got["e"].moments["mean"] is None
    for g, x in groups.items():
        sound, m = x[np.isfinite(x)], got[g].moments
        assert (m["count"], m["nonfinite"]) == (len(sound), len(x) - len(sound))
        assert [m["min"], m["max"], m["abs_max"]] == [sound.min(), sound.max(), np.abs(sound).max()]
        assert [got[g].m, got[g].s] == pytest.approx([np.median(sound), np.median(np.abs(sound))], rel=1e-12, abs=1e-300)
        if g != "b":
            # The spread of "a" is a billionth of its mean.
            assert [m["sum"], m["mean"], m["std"], m["abs_sum"], m["square_sum"]] == pytest.approx([sound.sum(), sound.mean(), sound.std(), np.abs(sound).sum(), (sound**2).sum()], rel=1e-4)


def test_running_total_and_numbers(frames):
    total = ordered.running_total(frames, ["e"], ["t"], ordered.index_block("t", 4), F.col("x"), "before")
    window = Window.partitionBy("e").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    checked = total.withColumn("want", F.coalesce(F.sum("x").over(window), F.lit(0.0)))
    assert checked.where("before <> want").count() == 0
    numbered = ordered.row_numbers(frames, [], ["e", "t"], ["e", ordered.index_block("t", 4)])
    assert sorted(r.row_number for r in numbered.collect()) == list(range(1, frames.count() + 1))


def test_sorted_numbers_with_hot_group_and_null_free_text(frames):
    got = ordered.sorted_numbers(frames, ["e"], [F.col("x").desc(), "t"])
    rank = F.row_number().over(Window.partitionBy("e").orderBy(F.col("x").desc(), "t"))
    checked = got.withColumn("want", rank)
    assert checked.where("row_number <> want").count() == 0
    assert checked.count() == frames.count()


def test_lookahead_sees_over_block_edges(frames):
    got = ordered.lookahead(frames, ["e"], "t", "t", 3, "ahead", rows=4)
    sizes = {r.e: r.n for r in frames.groupBy("e").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in got.collect():
        assert r.ahead == [i for i in range(r.t, r.t + 3) if i < sizes[r.e]]
    assert got.count() == frames.count()


@pytest.mark.parametrize("limit", [0, 200_000])
def test_quantiles_are_exact(spark, monkeypatch, limit):
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", limit)
    draw = np.random.default_rng(3)
    groups = {
        None: draw.normal(0, 1e-3, 400),
        "hot": np.concatenate([np.zeros(500), draw.normal(1e6, 1, 700), draw.normal(0, 1e-9, 9)]),
        "one": np.array([-3.5]),
        "two": np.array([1.0, 2.0]),
        "wide": np.array([-1e300, -1.0, 0.0, 1e-310, 5.0, 1e300]),
    }
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    probabilities = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", probabilities).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in probabilities.items():
            assert got[g][name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-300)


def test_weighted_quantiles_and_fan_out(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 10.0, 1), ("b", 2.0, 2)], "g string, v double, n long")
    one = quantiles.exact_quantiles(df, ["g"], "v", {"q": 0.75}, weight="n").collect()
    assert {r.g: r.q for r in one} == {"a": 3.25, "b": 2.0}
    both = F.array(F.struct(F.lit("all").alias("s")), F.struct(F.col("g").alias("s")))
    many = quantiles.exact_quantiles(df, ["s"], "v", {"q": 0.5}, weight="n", fan_out=both).collect()
    assert {r.s: r.q for r in many} == {"all": 1.5, "a": 1.0, "b": 2.0}
