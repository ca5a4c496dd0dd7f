"""Append split roots and report on the result (S1-S5 > V1 > U2 > A4, A5, A7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from episodica.operators.merge import append_split_roots
from episodica.operators.quantiles import match
from episodica.operators.statistics import dataset_totals, episode_stats, merge_stats


def append_report(frames: DataFrame, episodes: DataFrame, tasks: DataFrame, value: str, exact: bool = True) -> DataFrame:
    """Totals of the merged splits with the statistics of one value.

    ``exact`` recomputes the statistics over the merged rows, as training statistics
    need; otherwise episode statistics are pooled (A5).
    """
    merged, new_episodes, new_tasks = append_split_roots(frames, episodes, tasks)
    totals = dataset_totals(new_episodes, new_tasks, by=["split"])
    if exact:
        stats = episode_stats(merged, value, ["split"])
    else:
        stats = merge_stats(episode_stats(merged, value, ["split", "episode_index"]), ["split"])
    return match(totals, stats, ["split"])
