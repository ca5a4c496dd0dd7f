"""Summaries whose rows are made once."""

from pyspark.sql import functions as F

from episodica.functions.vectors import joint_groups
from episodica.operators import errors, strategies
from episodica.plans import plateau

from tests.conftest import rows


def pair_rows(spark):
    made = [
        (e, f, e % 2, "t%d" % (e % 3), "c%d" % (e % 2), float(e * f), e * f + 0.5, e - f * 0.25)
        for e in range(9) for f in range(1 + e % 4)
    ]
    return spark.createDataFrame(made, "episode_index long, frame_index long, joint_index long, task string, cohort string, expert double, intact double, counterfactual double")


def test_condition_summary_counts_rows_as_frames(spark):
    pairs, groups = pair_rows(spark), F.array(F.lit("all"), F.format_string("j%d", "joint_index"))
    numbered = errors.condition_summary(pairs, groups=groups)
    assert rows(errors.condition_summary(pairs.drop("frame_index"), frame=(), groups=groups)) == rows(numbered)
    whole = [r for r in numbered.collect() if r["scope"] == "all_tasks" and r["group"] == "all"]
    assert {(r["episodes"], r["frames"], r["sample_count"]) for r in whole} == {(9, pairs.count(), pairs.count())}


def test_condition_summary_makes_its_pairs_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    pairs = pair_rows(spark).coalesce(1)
    counted = pairs.mapInArrow(seen, pairs.schema)
    errors.condition_summary(counted, groups=F.array(F.lit("all"))).collect()
    assert made.value == pairs.count()


def test_strategy_table_needs_no_shuffle_and_equals_long_rows(spark):
    chunk = lambda e: [[e * 0.5 + h, float("nan") if e == 4 and h == 1 else e - h * h * 0.25] for h in range(4)]
    made = [(1, "train", f"v{e}", e, o, 0, e % 2 == 0, e % 3 == 0, "left", chunk(e), chunk(e + 1)[:4], [float(e), None if e == 2 else 1.0], chunk(e + 2)[: 1 if e == 5 else 2]) for e in range(7) for o in (1, 2)]
    kinds = "checkpoint_step long, split string, event_id string, episode_index long, decision_offset int, noise_repeat long, window_all_stale boolean, strong boolean, moving_hand string"
    vectors = "stale_chunk array<array<double>>, fresh_chunk array<array<double>>, pre_dropout_command array<double>, expert_window array<array<double>>"
    decisions = spark.createDataFrame(made, f"{kinds}, {vectors}")
    layout = [("left_hand", 0, 1), ("right_hand", 1, 2)]
    got = plateau.strategy_table(decisions, 2, layout)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()

    keys = plateau.WINDOW
    before = F.element_at("fresh_chunk", F.col("decision_offset"))
    windows = strategies.strategy_windows(decisions.withColumns({"event_class": F.when(F.col("strong"), "strong_action_change").otherwise("ambiguous_stationary"), "_b": before}), 2)
    previous = F.when(F.col("strategy") == strategies.CONTINUE, F.col("_b")).otherwise(F.col("pre_dropout_command"))
    long = strategies.window_rows(windows.select(*keys, "window", "expert_window", "pre_dropout_command", previous.alias("_p")))
    long = long.select(
        *keys, "horizon_position", "joint_index", "prediction", F.get(F.get("expert_window", "horizon_position"), F.col("joint_index")).alias("expert"),
        F.get("pre_dropout_command", "joint_index").alias("fresh_command"), F.get("_p", "joint_index").alias("previous_command"),
    ).withColumn("group", F.explode(joint_groups(F.col("joint_index"), layout)))
    wanted = strategies.strategy_metrics(long, keys)
    close = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(repr, map(close, rows(got, *wanted.columns)))) == sorted(map(repr, map(close, rows(wanted))))


def noisy_decisions(spark):
    chunk = lambda e, n: [[e * 0.5 + h + n, e - h * h * 0.25] for h in range(4)]
    made = [
        (1, "train", f"v{e}", e // 3, o, n, e % 2 == 0, e % 3 == 0, "left" if e % 2 else None, chunk(e, n), chunk(e + 1, n), [float(e), 1.0], chunk(e + 2, 0)[:2])
        for e in range(7) for o in (1, 2) for n in range(3)
    ]
    kinds = "checkpoint_step long, split string, event_id string, episode_index long, decision_offset int, noise_repeat long, window_all_stale boolean, strong boolean, moving_hand string"
    vectors = "stale_chunk array<array<double>>, fresh_chunk array<array<double>>, pre_dropout_command array<double>, expert_window array<array<double>>"
    return spark.createDataFrame(made, f"{kinds}, {vectors}")


def test_baseline_table_equals_the_joined_baseline(spark):
    layout = [("left_hand", 0, 1), ("right_hand", 1, 2)]
    decisions = noisy_decisions(spark).repartition(3, "split", "event_id", "decision_offset")
    got = plateau.baseline_table(decisions, 2, layout)
    # One exchange deals the decisions; the baseline and the first of an event need none.
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    wanted = strategies.join_hold_baseline(plateau.strategy_table(decisions, 2, layout)).drop("mse_delta_vs_hold")
    assert rows(got, *wanted.columns) == rows(wanted)
    assert {(r.noise_repeat, r.first_of_event) for r in got.collect()} == {(0, True), (1, False), (2, False)}


def test_summary_of_the_baseline_table_counts_events_once(spark):
    layout = [("left_hand", 0, 1), ("right_hand", 1, 2)]
    decisions = noisy_decisions(spark)
    got = strategies.strategy_summary_by(plateau.baseline_table(decisions, 2, layout), "moving_hand", replicates=20)
    wanted = strategies.strategy_summary_by(plateau.strategy_table(decisions, 2, layout), "moving_hand", replicates=20)
    close = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(repr, map(close, rows(got)))) == sorted(map(repr, map(close, rows(wanted, *got.columns))))
    whole = [r for r in got.collect() if r.window_scope == "all_windows" and r["group"] == "all" and r.decision_offset == 1]
    assert {(r.moving_hand, r.episodes, r.events, r.noise_samples) for r in whole} == {("left", 2, 3, 9), (None, 3, 4, 12)}
