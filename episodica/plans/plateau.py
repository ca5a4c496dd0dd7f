"""Decisions with chunks to strategy metrics (W3 > P16 > J12 > W6 > A17 > A18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodica.contract import Layout
from episodica.functions.vectors import joint_groups
from episodica.operators.strategies import CONTINUE, FIRST, baseline_metrics, strategy_windows, whole_window, window_metrics, windows_of

WINDOW = [
    "checkpoint_step", "split", "event_id", "episode_index", "decision_offset", "noise_repeat",
    "window_all_stale", "event_class", "moving_hand", "strategy",
]


def strategy_table(decisions: DataFrame, horizon: int, layout: Layout, keys=WINDOW) -> DataFrame:
    """A17 from decisions with ``fresh_chunk, stale_chunk, pre_dropout_command,
    expert_window``, one row per decision. The command before a continued chunk is its own preceding step."""
    windows = strategy_windows(_ready(decisions), horizon)
    previous = F.when(F.col("strategy") == CONTINUE, F.col("_before")).otherwise(F.col("pre_dropout_command"))
    windows = windows.select(
        *keys, "window", "expert_window", F.col("pre_dropout_command").alias("fresh_command"), previous.alias("previous_command")
    )
    return window_metrics(windows, keys, lambda joint: joint_groups(joint, layout))


def _ready(decisions: DataFrame) -> DataFrame:
    kind = F.when(F.col("strong"), "strong_action_change").otherwise("ambiguous_stationary")
    before = F.element_at("fresh_chunk", F.greatest(F.col("decision_offset"), F.lit(1)).cast("int"))
    return decisions.withColumns({"event_class": kind, "_before": before})


def baseline_table(decisions: DataFrame, horizon: int, layout: Layout, keys=WINDOW) -> DataFrame:
    """``strategy_table`` with each row's ``hold_mse`` (J6) and whether its decision is the ``first_of_event``.

    A decision is one row, which must name one window: all its strategies are made in that row, so
    the baseline is at hand there. The first of an event is told per offset, among its noise repeats.
    """
    keys = [k for k in keys if k != "strategy"]
    ready = _ready(decisions)
    event = Window.partitionBy("checkpoint_step", "split", "event_id", "decision_offset", "episode_index").orderBy("noise_repeat")
    kind = ready.schema["stale_chunk"].dataType.simpleString()
    windows = {n: whole_window(w, horizon, kind) for n, w in windows_of(horizon).items()}
    previous = {n: F.col("_before" if n == CONTINUE else "pre_dropout_command") for n in windows}
    made = baseline_metrics(windows, "expert_window", "pre_dropout_command", previous, lambda joint: joint_groups(joint, layout))
    rows = ready.withColumn(FIRST, F.row_number().over(event) == 1).select(*keys, FIRST, made.alias("_metrics"))
    return rows.select(*keys, FIRST, F.explode("_metrics").alias("_m")).select(*keys, FIRST, "_m.*")
