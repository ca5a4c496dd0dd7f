"""Donors, plateaus, strategies and effects on the small cases with known answers."""

import pytest
from pyspark.sql import functions as F

from episodica.functions import phases
from episodica.operators import bootstrap, donors, errors, plateaus, strategies
from episodica.operators.ordered import index_block
from episodica.plans.correspondence import effect_report
from tests.conftest import rows


@pytest.mark.parametrize(
    ("t", "n", "m", "phase", "want"),
    [
        (0, 101, 51, "phase_matched", 0), (50, 101, 51, "phase_matched", 25), (100, 101, 51, "phase_matched", 50),
        (0, 101, 51, "out_of_phase", 25), (25, 101, 51, "out_of_phase", 38), (50, 101, 51, "out_of_phase", 0),
        (100, 101, 51, "out_of_phase", 25), (0, 1, 51, "phase_matched", 0), (3, 9, 1, "out_of_phase", 0),
    ],
)
def test_phase_frames(spark, t, n, m, phase, want):
    df = spark.range(1).select(phases.phase_frame(F.lit(t), F.lit(n), F.lit(m), phase).alias("f"))
    assert df.first().f == want


@pytest.mark.parametrize(("t", "want"), [(0, 10), (90, 100), (100, 9)])
def test_offset_frames(spark, t, want):
    df = spark.range(1).select(phases.offset_frame(F.lit(t), F.lit(101), 0.10).alias("f"))
    assert df.first().f == want


def test_donors_form_one_circle_per_task(spark):
    data = [(f"t{e % 2}", e, 10 + e) for e in range(21)]
    episodes = spark.createDataFrame(data, "task string, episode_index long, length long")
    got = donors.donor_derangement(episodes, seed=7, repeats=3)
    task = {e: t for t, e, _ in data}
    for repeat in range(3):
        pairs = {r.recipient_episode_index: r.donor_episode_index for r in got.where(F.col("shuffle_repeat") == repeat).collect()}
        assert set(pairs) == set(pairs.values()) == set(task)
        assert all(task[a] == task[b] and a != b for a, b in pairs.items())
    assert rows(got) == rows(donors.donor_derangement(episodes.repartition(7), seed=7, repeats=3))


def test_single_episode_has_no_donor(spark):
    episodes = spark.createDataFrame([("a", 1, 5)], "task string, episode_index long, length long")
    with pytest.raises(Exception, match="no donor"):
        donors.donor_derangement(episodes, 1).collect()
    assert donors.donor_feasibility(episodes).count() == 1


def plateau_frames(spark):
    data = []
    for t in range(50):
        held = 5 if 5 <= t <= 34 else t
        data.append(("d", "validation", 0, t, [0.0] * 2, [float(held)] * 2, [0.0, 0.0], [0.2 * t / 49, 0.0]))
    return spark.createDataFrame(
        data,
        "dataset string, split string, episode_index long, frame_index long, state_left_hand array<double>, "
        "state_right_hand array<double>, action_left_hand array<double>, action_right_hand array<double>",
    )


@pytest.mark.parametrize("block", [4, 65536])
def test_plateau(spark, block):
    got = plateaus.detect_plateaus(
        plateau_frames(spark), block=index_block("frame_index", block), strong_action_range=0.05
    ).collect()
    assert len(got) == 1
    event = got[0]
    assert (event.fresh_proxy_frame, event.plateau_end_frame, event.plateau_frames) == (5, 34, 30)
    assert event.strong and event.moving_hand == "right" and event.event_index == 0
    assert event.duration_s == pytest.approx(29 / 30)


def test_decisions_and_skip_reasons(spark):
    data = [("a", 0, 40), ("b", 5, 34), ("c", 38, 49)]
    events = spark.createDataFrame(data, "event_id string, fresh_proxy_frame long, plateau_end_frame long")
    events = events.withColumn("length", F.lit(50))
    got = plateaus.plan_decisions(events, (1, 8, 16), 8, 16)
    reasons = {(r.event_id, r.decision_offset): r.skip_reason for r in got.collect()}
    assert reasons[("a", 1)] == "plateau_starts_at_episode_start"
    assert reasons[("b", 1)] is None and reasons[("b", 8)] is None
    assert reasons[("b", 16)] == "previous_chunk_slice_exceeds_action_horizon"
    assert reasons[("c", 8)] == "expert_window_crosses_episode_end"
    assert reasons[("c", 16)] == "decision_anchor_after_plateau"
    stale = {(r.event_id, r.decision_offset): r.window_all_stale for r in plateaus.decisions(got).collect()}
    assert stale[("b", 8)] and stale[("b", 1)]


def test_strategy_metrics(spark):
    expert, prediction = [[1.0, 2.0], [2.0, 4.0]], [[2.0, 2.0], [4.0, 2.0]]
    data = [
        ("w", h, j, prediction[h][j], expert[h][j], [1.5, 2.0][j], [1.5, 2.0][j])
        for h in range(2)
        for j in range(2)
    ]
    df = spark.createDataFrame(
        data, "w string, horizon_position int, joint_index int, prediction double, expert double, "
        "fresh_command double, previous_command double",
    ).withColumn("group", F.lit("all"))
    m = strategies.strategy_metrics(df, ["w"]).first()
    assert (m.mae, m.mse) == (1.25, 2.25)
    assert m.jump_from_fresh_proxy_command_mae == 0.25
    assert m.within_window_mean_absolute_slew == 1.0


def test_strategy_windows_check_their_length(spark):
    df = spark.createDataFrame(
        [(1, [[1.0], [2.0]], [[3.0], [4.0], [5.0]], [9.0])],
        "decision_offset int, stale_chunk array<array<double>>, fresh_chunk array<array<double>>, pre_dropout_command array<double>",
    )
    got = {r.strategy: r.window for r in strategies.strategy_windows(df, 2).collect()}
    assert got[strategies.STALE] == [[1.0], [2.0]]
    assert got[strategies.HOLD] == [[9.0], [9.0]]
    assert got[strategies.CONTINUE] == [[4.0], [5.0]]
    with pytest.raises(Exception, match="another length"):
        strategies.strategy_windows(df, 3).collect()


def test_two_hold_rows_fail(spark):
    data = [(1, "s", "e", 1, 0, "all", strategies.HOLD, 1.0)] * 2
    df = spark.createDataFrame(
        data, "checkpoint_step int, split string, event_id string, decision_offset int, noise_repeat int, "
        "group string, strategy string, mse double",
    )
    with pytest.raises(Exception, match="several hold rows"):
        strategies.join_hold_baseline(df).collect()


def paired(spark):
    """Three episodes of ten samples with deltas 0.2 (a), 0.4 (a) and 0.6 (b)."""
    data = []
    for episode, (task, delta) in enumerate([("a", 0.2), ("a", 0.4), ("b", 0.6)]):
        data += [(0, episode, task, "base", "all", 1.0, 1.0 + delta, 0.0, t) for t in range(10)]
    return spark.createDataFrame(
        data, "shuffle_repeat int, episode_index long, task string, cohort string, group string, "
        "intact double, counterfactual double, expert double, frame_index int",
    )


def test_paired_effects(spark):
    out = {(r.scope, r.scope_value): r for r in effect_report(paired(spark), replicates=50).collect()}
    whole = out[("all_tasks", "all")]
    assert whole.micro_delta_mae == pytest.approx(0.4)
    assert whole.episode_macro_mean_delta_mae == pytest.approx(0.4)
    assert whole.task_balanced_mean_delta_mae == pytest.approx(0.45)
    assert whole.episode_win_rate_counterfactual_worse == 1
    assert 0.4 - 1e-9 <= whole.task_balanced_delta_mae_ci95_low <= whole.task_balanced_delta_mae_ci95_high <= 0.5 + 1e-9
    assert set(out) == {("all_tasks", "all"), ("task", "a"), ("task", "b"), ("cohort", "base")}


def test_bootstrap_keeps_null_groups_and_weighs_rows(spark):
    data = [(None, 1, 1.0)] * 9 + [(None, 2, 0.0)] + [("s", 3, 5.0)] * 2
    df = spark.createDataFrame(data, "source string, episode_index long, v double")
    got = {r.source: r for r in bootstrap.cluster_bootstrap_ci(df, "v", index_block("episode_index"), 200, 1, ["source"]).collect()}
    assert set(got) == {None, "s"}
    assert got["s"].ci95_low == got["s"].ci95_high == 5.0
    assert got[None].ci95_low == 0.0 and got[None].ci95_high == 1.0


def test_error_metrics_of_one_group(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, 0.0), (10.0, 0.0)], "prediction double, expert double")
    m = errors.error_metrics(df, []).first()
    assert m.p95_absolute_error == pytest.approx(8.95)
    assert (m.sample_count, m.mae, m.median_absolute_error) == (4, 4.0, 2.5)


def test_chunks_stop_at_the_episode_end(spark):
    df = spark.createDataFrame([(8, h, 10) for h in range(8)], "anchor_frame int, horizon_position int, length int")
    assert errors.action_chunks(df).count() == 2


def test_quantiles_of_groups_with_nan_and_infinity(spark):
    import numpy as np
    from episodica.operators.quantiles import exact_quantiles

    inf, nan = float("inf"), float("nan")
    groups = {"n": [1.0, 2.0, 3.0, nan], "small": [0.1, 0.2, 0.3, nan], "up": [1.0, 2.0, 5.0, inf], "down": [-inf, -1.0, 0.0, 4.0], "both": [-inf, 1.0, 2.0, 3.0, inf], "all": [nan], "ends": [inf, inf, inf], "plain": [0.0, -0.0, 1e-310, -7.5, 7.5]}
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double")
    wanted = {"median": 0.5, "p95": 0.95, "q01": 0.01}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", wanted).collect()}
    for g, values in groups.items():
        for name, p in wanted.items():
            # Beside an infinity the rule low + (high - low) * part, where NumPy's other branch gives NaN.
            low, high = (float(np.quantile(np.array(values), p, method=m)) for m in ("lower", "higher"))
            part = p * (len(values) - 1) % 1
            right = float(np.quantile(np.array(values), p)) if np.isfinite([low, high]).all() else low if low == high else low + (high - low) * part
            assert np.isclose(got[g][name], right, equal_nan=True), (g, name)


def test_donors_stay_in_their_split(spark):
    episodes = spark.createDataFrame([(s, "t", e, 4) for s in ("train", "test") for e in range(3)], "split string, task string, episode_index long, length long")
    frames = episodes.select("split", "task", "episode_index", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("frame_index"))
    frames = frames.withColumn("view", F.concat("split", F.lit(":"), F.col("episode_index").cast("string"), F.lit(":"), F.col("frame_index").cast("string")))
    ring = donors.donor_derangement(episodes, 3, by=["split"])
    mapping = donors.frame_mapping(donors.anchors(frames, 2), ring, "phase_matched", by=["split"])
    got = donors.fetch_donor_frame(mapping, frames, "view", by=["split"]).collect()
    assert len(got) == 12 and all(r.replacement == f"{r.split}:{r.donor_episode_index}:{r.donor_frame}" for r in got)
    with pytest.raises(Exception, match="donor frame is not in"):
        donors.fetch_donor_frame(mapping, frames.where("split = 'train'"), "view", by=["split"]).collect()
    with pytest.raises(Exception, match="has no donor"):
        donors.frame_mapping(frames, ring.where("split = 'train'"), "phase_matched", by=["split"]).collect()
