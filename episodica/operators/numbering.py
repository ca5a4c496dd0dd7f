"""New indices and names after merges and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.labels import name_number, numbered_name
from episodica.operators.ordered import first_rows, index_block, running_total, running_totals, sorted_numbers
from episodica.shared import sized


def renumber_episodes(episodes: DataFrame, by=("split",), source="source_rank", episode="episode_index", length="length"):
    """``new_episode_index`` and ``first_index`` of every episode of a merge.

    Sources follow each other by rank and keep their own episode order.
    """
    block = [F.col(source), index_block(episode)]
    order = [source, episode]
    totals = {"new_episode_index": F.lit(1).cast("long"), "first_index": F.col(length).cast("long")}
    return running_totals(episodes, by, order, block, totals)


def renumber_frames(frames: DataFrame, numbered: DataFrame, keys=("split", "source_rank", "episode_index")):
    """Frames with their new episode and global index."""
    new = numbered.select(*keys, "new_episode_index", "first_index")
    out = frames.join(new, list(keys))
    return out.withColumns(
        {
            "episode_index": F.col("new_episode_index"),
            "index": F.col("first_index") + F.col("frame_index"),
        }
    ).drop("new_episode_index", "first_index")


def append_names(destination: DataFrame, incoming: DataFrame, name="episode", order=("episode",), by=()):
    """Incoming episodes numbered after the destination's largest number."""
    by = list(by)
    top = destination.groupBy(*by).agg(
        F.max(name_number(F.col(name))).alias("_top"), F.max(F.length(name) - 8).alias("_width")
    )
    numbered = sorted_numbers(incoming, by, list(order), "_rank")
    if by:
        joined = numbered.join(sized(top), by, "left")
        number = F.coalesce("_top", F.lit(0)) + F.col("_rank")
    else:
        joined = numbered
        number = F.coalesce(top.select("_top").scalar(), F.lit(0)) + F.col("_rank")
    return joined.withColumn("new_name", numbered_name(number)).drop("_rank", "_top", "_width")


def split_names(
    records: DataFrame, component="component_rank", name="source_episode", split="split"
) -> DataFrame:
    """Per split a name by component order and source number, and one global
    flattened name by the same order."""
    rows = records.withColumn("_number", name_number(F.col(name)))
    order = [component, "_number"]
    block = [F.col(component), index_block("_number")]
    rows = running_total(rows, [split], order, block, F.lit(1).cast("long"), "_in_split")
    rows = running_total(rows, [], order, block, F.lit(1).cast("long"), "_in_all")
    return rows.withColumns(
        {
            "split_episode": numbered_name(F.col("_in_split") + 1),
            "flattened_episode": numbered_name(F.col("_in_all") + 1),
        }
    ).drop("_number", "_in_split", "_in_all")


def flatten_sessions(episodes: DataFrame, session="source_session", name="source_episode") -> DataFrame:
    """One flat numbering by case-folded session path, then episode number."""
    number = name_number(F.col(name))
    # Ties of the folded path (paths that differ in case only) fall back to the path.
    order = [F.lower(F.col(session)), number, F.col(session)]
    out = sorted_numbers(episodes, [], order, "_number")
    return out.withColumn("flattened_episode", numbered_name(F.col("_number"))).drop("_number")


def first_n(df: DataFrame, n: int, by=(), order=("episode_index",), block: Column | None = None) -> DataFrame:
    """The first ``n`` rows of each group in order, with their ``selection`` label.

    ``block`` is a monotone function of the first order column; where it is an integer, blocks
    of 65536 values are the default. See ``first_rows`` for hot groups.
    """
    block = index_block(order[0]) if block is None else block
    return first_rows(df, by, list(order), block, n).withColumn("selection", F.lit(f"first_{n}"))
