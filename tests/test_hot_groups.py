"""Only hot groups are cut into blocks; tasks are cut by rows; small episodes meet in one aggregation."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from episodica.catalog import base
from episodica.functions.vectors import joint_groups
from episodica.operators import errors, ordered
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    draw = random.Random(3)
    data = [("hot", i, float(draw.randint(0, 9))) for i in range(200)]
    data += [(f"e{n}", i, float(draw.randint(0, 9))) for n in range(20) for i in range(draw.randint(1, 9))]
    draw.shuffle(data)
    return spark.createDataFrame(data, "e string, t long, x double").repartition(5).cache()


@pytest.mark.parametrize("limit", [50, 1000])
def test_numbers_and_neighbours_cut_hot_groups_only(frames, limit):
    hot = ordered.hot_groups(frames, ["e"], limit)
    assert [r.e for r in hot.collect()] == (["hot"] if limit == 50 else [])
    order = Window.partitionBy("e").orderBy("t")
    block = ordered.index_block("t", 4)
    got = ordered.row_numbers(frames, ["e"], ["t"], block, "n", start=0, hot=hot)
    assert rows(got, "e", "t", "x", "n") == rows(frames.withColumn("n", F.row_number().over(order).cast("long") - 1), "e", "t", "x", "n")
    want = frames.withColumns({"previous_x": F.lag("x").over(order), "next_x": F.lead("x").over(order)})
    got = ordered.neighbours(frames, ["e"], ["t"], block, ["x"], ["x"], hot=hot)
    assert rows(got, *want.columns) == rows(want)


def test_frames_of_predictions_read_lines_once(spark):
    plan = base.pairs(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Relation [l_orderkey") <= 1 and "Aggregate" not in plan


def test_tasks_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITION_ROWS", 500)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert base.pair_rows(spark, SF).rdd.getNumPartitions() == -(-lines // 500)
    assert base.pairs(spark, SF).rdd.getNumPartitions() == -(-lines // 500)


def test_conditions_of_small_and_hot_episodes_agree(spark):
    draw = random.Random(5)
    data = [(e, draw.uniform(-1, 1), draw.choice([None, draw.uniform(-1, 1)]), draw.uniform(-1, 1)) for e in range(6) for _ in range(1 + 9 * e)]
    data += [(6, float("nan"), 1.0, 0.5), (6, 2.0, 3.0, 0.5), (7, None, None, 1.0)]
    pairs = spark.createDataFrame(data, "episode_index long, intact double, counterfactual double, expert double")

    def of(hot):
        found = errors.episode_condition_metrics(pairs, ["episode_index"], hot)
        return rows(found.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in sorted(found.dtypes)]))

    want = of(None)
    assert len(want) == 16
    assert str(of(ordered.hot_groups(pairs, ["episode_index"], 1000))) == str(want)
    assert str(of(ordered.hot_groups(pairs, ["episode_index"], 20))) == str(want)


@pytest.mark.parametrize("summary", ["horizon", "condition"])
def test_groups_fan_out_from_cells(spark, summary):
    layout = [("left_arm", 0, 2), ("right_hand", 2, 3)]
    data = [(f"t{e % 2}", f"c{e % 3}", e, f, j, f % 2, 0.1 * j + f, 0.3 * e, 0.05 * e * j) for e in range(5) for f in range(4) for j in range(3)]
    pairs = spark.createDataFrame(
        data, "task string, cohort string, episode_index long, frame_index long, joint_index int, horizon_position int, intact double, counterfactual double, expert double"
    )
    groups = joint_groups(F.col("joint_index"), layout)
    run = errors.horizon_summary if summary == "horizon" else errors.condition_summary
    want, got = run(pairs.withColumn("group", F.explode(groups))), run(pairs, groups=groups)
    tidy = lambda df: rows(df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in sorted(df.dtypes)]))
    assert tidy(got) == tidy(want)


def test_effects_are_summed_where_the_join_has_put_them(spark, monkeypatch):
    from episodica.catalog.evaluation import EFFECT_KEYS

    monkeypatch.setattr(ordered, "PARTITION_ROWS", 500)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = errors.episode_pairs(base.grouped(base.plain_pairs(spark, SF)), EFFECT_KEYS)
        assert "hashpartitioning(shuffle_repeat" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_means_leave_out_missing_predictions(spark):
    pairs = spark.createDataFrame([(1, 1.0, None, 0.0), (1, 3.0, 2.0, 1.0)], "e int, intact double, counterfactual double, expert double")
    got = errors.episode_pairs(pairs, ["e"]).first()
    assert (got.sample_count, got.intact_mae, got.counterfactual_mae, got.mean_absolute_prediction_change) == (2, 1.5, 1.0, 1.0)
