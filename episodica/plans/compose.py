"""Split every component of a collection and name the result (T1-T4 > W11)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from episodica.operators.numbering import split_names
from episodica.operators.splits import split_goal_stratified, split_session_grouped


def compose_collection(
    episodes: DataFrame, seed: int, strategy: str = "goal-stratified", trials: int = 20000
) -> DataFrame:
    """Planned records: split, name in the split and flattened name of every episode.

    ``episodes``: ``source_dataset, component_rank, source_session, source_episode,
    goal, episode_index``. Goal-stratified splits all components in one pass;
    session-grouped treats the collection as one component.
    """
    if strategy == "goal-stratified":
        rows = split_goal_stratified(episodes, seed, by=["source_dataset"])
    elif strategy == "session-grouped":
        rows = split_session_grouped(episodes, seed, trials)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return split_names(rows)
