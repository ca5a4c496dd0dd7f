"""Plateaus of the hand state and the decisions taken in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.contract import EPISODE
from episodica.operators.ordered import index_block, row_numbers, runs
from episodica.shared import checkpointed


def detect_plateaus(
    frames: DataFrame,
    states=("state_left_hand", "state_right_hand"),
    actions=("action_left_hand", "action_right_hand"),
    by=EPISODE,
    order=("frame_index",),
    frame: str = "frame_index",
    block: Column | None = None,
    fps: float = 30.0,
    minimum_frames: int = 25,
    strong_action_range: float = 0.02,
) -> DataFrame:
    """Maximal runs of equal hand state, at least ``minimum_frames`` long.

    States and actions are vectors or scalars. The range of a hand is the largest
    range of its joints in the run. Kept runs are numbered in frame order.
    """
    by = list(by)
    block = index_block(order[0]) if block is None else block
    rows = frames.select(*dict.fromkeys([*by, *order, frame, *states, *actions]))
    vector = frames.schema[actions[0]].dataType.typeName() == "array"
    pieces_of, runs_of = _joint_ranges(frame, actions, order) if vector else _ranges(frame, actions)
    found = runs(rows, by, order, block, list(states), "_run", pieces_of, runs_of)
    left = F.col("left_action_range") >= strong_action_range
    right = F.col("right_action_range") >= strong_action_range
    kept = found.where(F.col("plateau_frames") >= minimum_frames).drop("_run")
    kept = kept.withColumns(
        {
            "stale_candidate_frames": F.greatest(F.col("plateau_frames") - 1, F.lit(0)),
            "duration_s": (F.col("plateau_frames") - 1) / F.lit(float(fps)),
            "strong": left | right,
            "moving_hand": F.when(left & right, "both")
            .when(left, "left")
            .when(right, "right")
            .otherwise("neither"),
        }
    )
    # One row per plateau, read twice by the numbering.
    return row_numbers(
        checkpointed(kept), by, ["fresh_proxy_frame"], index_block("fresh_proxy_frame"), "event_index", start=0
    )


def _run_columns(left: Column, right: Column) -> list[Column]:
    return [
        F.min("_first").alias("fresh_proxy_frame"),
        F.max("_last").alias("plateau_end_frame"),
        left.alias("left_action_range"),
        right.alias("right_action_range"),
    ]


def _ranges(frame: str, actions):
    """Ranges of two scalar actions: minima and maxima of pieces, then of runs."""

    def pieces_of(rows: DataFrame, keys, ends) -> DataFrame:
        sides = zip(("left", "right"), actions, strict=True)
        extremes = [f(a).alias(f"_{f.__name__}_{n}") for n, a in sides for f in (F.min, F.max)]
        size = [F.min(frame).alias("_first"), F.max(frame).alias("_last"), F.count(F.lit(1)).alias("_n")]
        return rows.groupBy(*keys).agg(*ends, *size, *extremes)

    def runs_of(pieces: DataFrame, keys) -> DataFrame:
        left, right = (F.max(f"_max_{n}") - F.min(f"_min_{n}") for n in ("left", "right"))
        return pieces.groupBy(*keys).agg(F.sum("_n").alias("plateau_frames"), *_run_columns(left, right))

    return pieces_of, runs_of


def _joint_ranges(frame: str, actions, order):
    """The same of action vectors: the largest range of a hand's joints. A piece holds a list with one entry per joint."""

    def side(name: str, action: str) -> Column:
        def joint(v: Column, j: Column) -> Column:
            return F.struct(F.lit(name).alias("hand"), j.alias("joint"), v.alias("v"))

        return F.transform(F.col(action), joint)

    size = [F.min("_first").alias("_first"), F.max("_last").alias("_last")]
    extremes = [F.min("_low").alias("_low"), F.max("_high").alias("_high")]

    def pieces_of(rows: DataFrame, keys, ends) -> DataFrame:
        kinds = F.concat(*[side(n, a) for n, a in zip(("left", "right"), actions, strict=True)])
        others = [c for c in rows.columns if c not in actions]
        joints = rows.select(*others, F.explode(kinds).alias("_j")).select(*others, "_j.*")
        joints = joints.groupBy(*keys, "hand", "joint").agg(
            *ends, F.min(frame).alias("_first"), F.max(frame).alias("_last"),
            F.count(F.lit(1)).alias("_n"), F.min("v").alias("_low"), F.max("v").alias("_high"),
        )
        return joints.groupBy(*keys).agg(
            F.any_value("_begin").alias("_begin"), F.any_value("_end").alias("_end"), *size,
            F.max("_n").alias("_n"), F.collect_list(F.struct("hand", "joint", "_low", "_high")).alias("_joints"),
        )

    def runs_of(pieces: DataFrame, keys) -> DataFrame:
        joints = pieces.select(*keys, "_first", "_last", "_n", F.explode("_joints").alias("_j")).select("*", "_j.*")
        joints = joints.groupBy(*keys, "hand", "joint").agg(*size, F.sum("_n").alias("_n"), *extremes)
        spread, first = F.col("_high") - F.col("_low"), F.col("hand") == "left"
        left, right = F.max(F.when(first, spread)), F.max(F.when(~first, spread))
        return joints.groupBy(*keys).agg(F.max("_n").alias("plateau_frames"), *_run_columns(left, right))

    return pieces_of, runs_of


def event_id(split: Column, episode: Column, first: Column, last: Column) -> Column:
    return F.format_string("%s:episode-%06d:frames-%d-%d", split, episode, first, last)


def plan_decisions(
    events: DataFrame,
    offsets=(1, 8, 16),
    execution_horizon: int = 8,
    action_horizon: int = 16,
    length: str = "length",
) -> DataFrame:
    """One row per (event, offset) with its anchor and target window.

    ``skip_reason`` is the first failing rule, null for a decision.
    """
    first, last = F.col("fresh_proxy_frame"), F.col("plateau_end_frame")
    rows = events.withColumn("decision_offset", F.explode(F.array(*[F.lit(o) for o in offsets])))
    anchor = first + F.col("decision_offset")
    end = anchor + (execution_horizon - 1)
    reason = (
        F.when(first == 0, "plateau_starts_at_episode_start")
        .when(anchor > last, "decision_anchor_after_plateau")
        .when(end >= F.col(length), "expert_window_crosses_episode_end")
        .when(
            F.col("decision_offset") + execution_horizon > action_horizon,
            "previous_chunk_slice_exceeds_action_horizon",
        )
    )
    return rows.withColumns(
        {
            "anchor_frame": anchor,
            "target_start_frame": anchor,
            "target_end_frame": end,
            "window_all_stale": end <= last,
            "skip_reason": reason,
        }
    )


def decisions(planned: DataFrame) -> DataFrame:
    return planned.where(F.col("skip_reason").isNull()).drop("skip_reason")


def skipped(planned: DataFrame) -> DataFrame:
    return planned.where(F.col("skip_reason").isNotNull())


def expert_window(
    planned: DataFrame, frames: DataFrame, values, by=EPISODE, frame: str = "frame_index"
) -> DataFrame:
    """Recorded values of every frame in ``[target_start, target_end]``.

    The window is a handful of frames, so it is unrolled and joined on equal
    (episode, frame) rather than by range.
    """
    steps = planned.withColumn(
        "target_frame", F.explode(F.sequence("target_start_frame", "target_end_frame"))
    ).withColumn("horizon_position", (F.col("target_frame") - F.col("target_start_frame")).cast("int"))
    wanted = frames.select(*by, F.col(frame).alias("target_frame"), *values)
    return steps.join(wanted, [*by, "target_frame"])
