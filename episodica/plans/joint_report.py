"""Scan to report: joint statistics of state, action and their gaps (S1 > A3 > A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.contract import EPISODE
from episodica.operators.statistics import command_state_gap, motion_statistics


def joint_report(
    frames: DataFrame, fps: float, names: list[str] | None = None, by=EPISODE, order=("frame_index",), block=None
) -> DataFrame:
    """One row per (source, joint) with value, delta and speed statistics.

    Frames are walked once for all four sources; only (source, joint, value) rows
    go on to the aggregates.
    """
    rows = command_state_gap(frames, by=by, order=order, block=block)
    long = rows.select("source", F.posexplode(F.arrays_zip("values", "deltas")).alias("joint_index", "z"))
    if names is None:
        label = F.format_string("joint_%d", "joint_index")
    else:
        label = F.get(F.array(*[F.lit(n) for n in names]), F.col("joint_index"))
    long = long.select(
        "source", "joint_index", label.alias("joint_name"),
        F.col("z.values").alias("value"), F.col("z.deltas").alias("delta"),
    )
    keys = ["source", "joint_index", "joint_name"]
    return motion_statistics(long, keys, fps).withColumn("sample_rate_hz", F.lit(float(fps)))
