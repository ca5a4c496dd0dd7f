"""Donors to paired effects (J1 > W4 > W5 > J4 > J5 > A10-A15)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from episodica.functions.phases import CURRENT_FRAME, OFFSETS, PHASES
from episodica.operators.bootstrap import stratified_bootstrap_ci
from episodica.operators.donors import frame_mappings
from episodica.operators.errors import episode_pairs, paired_effects, scopes
from episodica.operators.ordered import index_block
from episodica.operators.quantiles import match
from pyspark.sql import functions as F


def all_mappings(anchors: DataFrame, donors: DataFrame, repeats: int, brightness_scale: float, by=()) -> DataFrame:
    """W5 for all seven interventions."""
    return frame_mappings(anchors, donors, [*PHASES, *OFFSETS, *CURRENT_FRAME], repeats, brightness_scale, by)


def effect_report(pairs: DataFrame, replicates: int = 10000, seed: int = 42) -> DataFrame:
    """A14 with the A15 interval per scope and group.

    ``pairs``: ``shuffle_repeat, episode_index, task, cohort, group, intact,
    counterfactual, expert``.
    """
    effects = episode_pairs(pairs, ["shuffle_repeat", "episode_index", "task", "cohort", "group"])
    out = paired_effects(effects)
    keys = ["scope", "scope_value", "group"]
    spread = effects.withColumn("_s", F.explode(scopes())).select("*", "_s.*")
    interval = stratified_bootstrap_ci(
        spread, "delta_mae_counterfactual_minus_intact", index_block("episode_index"), replicates, seed, keys
    )
    named = interval.withColumnsRenamed(
        {c: f"task_balanced_delta_mae_{c}" for c in ("ci95_low", "ci95_high")}
    )
    return match(out, named, keys, "left")
