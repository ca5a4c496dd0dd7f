"""Per-joint and per-episode statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.contract import EPISODE, is_finite
from episodica.functions.vectors import explode_joints
from episodica.operators.ordered import index_block, neighbours, previous_row
from episodica.operators.offsets import offset_profile
from episodica.operators.quantiles import SIZE, VALUE, match, profile
from episodica.shared import sized

PERCENTILES = {"p01": 0.01, "p05": 0.05, "median": 0.50, "p95": 0.95, "p99": 0.99}
EPISODE_QUANTILES = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}
TAILS = {"p95": 0.95, "p99": 0.99}


def _minus(later: Column, earlier: Column) -> Column:
    return F.zip_with(later, earlier, lambda a, b: a - b)


def pool_sources(*frames: DataFrame) -> DataFrame:
    """Rows of several datasets stacked for one statistic."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def pooling_faults(infos: DataFrame) -> DataFrame:
    """Datasets whose fps is missing, not positive, or differs from the others."""
    bad = infos.where(F.col("fps").isNull() | ~is_finite(F.col("fps")) | (F.col("fps") <= 0))
    spread = infos.agg(F.min("fps").alias("low"), F.max("fps").alias("high"))
    apart = spread.where(
        F.abs(F.col("high") - F.col("low")) > 1e-8 + 1e-5 * F.abs(F.col("low"))
    )
    return bad.select(
        F.lit("fps").alias("check"), "dataset", F.col("fps").cast("string").alias("detail")
    ).unionByName(
        apart.select(
            F.lit("fps differs").alias("check"),
            F.lit(None).cast("string").alias("dataset"),
            F.concat_ws("-", "low", "high").alias("detail"),
        )
    )


def frame_delta(df, value: str, by=EPISODE, order=("frame_index",), block=None, name="delta"):
    """x(t) - x(t-1) within an episode; null on its first row. Scalars or vectors."""
    block = index_block(order[0]) if block is None else block
    df = previous_row(df, by, order, [value], block)
    vector = df.schema[value].dataType.typeName() == "array"
    before = F.col(f"previous_{value}")
    delta = _minus(F.col(value), before) if vector else F.col(value) - before
    return df.withColumn(name, delta).drop(f"previous_{value}")


def next_frame_gap(df, action: str, state: str, by=EPISODE, order=("frame_index",), block=None):
    """``gap`` = action(t) - state(t+1), absent on the last row, and ``gap_delta``."""
    block = index_block(order[0]) if block is None else block
    df = neighbours(df, by, order, block, [action], [state])
    minus = _minus if df.schema[state].dataType.typeName() == "array" else lambda a, b: a - b
    gap = minus(F.col(action), F.col(f"next_{state}"))
    before = minus(F.col(f"previous_{action}"), F.col(state))
    df = df.withColumns({"gap": gap, "_before": before}).withColumn("gap_delta", minus(F.col("gap"), F.col("_before")))
    return df.drop(f"previous_{action}", f"next_{state}", "_before").where(F.col("gap").isNotNull())


def command_state_gap(df, action="action", state="state", by=EPISODE, order=("frame_index",), block=None):
    """A3: the four value sources with their within-episode deltas, one vector per row.

    Action, state and the next state are read in one pass over the episode: the
    deltas of all sources follow from the rows before and after.
    """
    block = index_block(order[0]) if block is None else block
    keys = [*by, *order]
    near = neighbours(df.select(*keys, action, state), by, order, block, [action, state], [state])
    act, now = F.col(action), F.col(state)
    act_before, before, after = (
        F.col(f"previous_{action}"), F.col(f"previous_{state}"), F.col(f"next_{state}")
    )
    same, ahead = _minus(act, now), _minus(act, after)

    def source(label, values, delta):
        # The first row of an episode has values but no deltas.
        none = F.transform(values, lambda x: F.lit(None).cast("double"))
        deltas = F.coalesce(delta, none).alias("deltas")
        return F.struct(F.lit(label).alias("source"), values.alias("values"), deltas)

    sources = F.array(
        source("action", act, _minus(act, act_before)),
        source("observation.state", now, _minus(now, before)),
        source("action_minus_state", same, _minus(same, _minus(act_before, before))),
        source("action_minus_next_state", ahead, _minus(ahead, _minus(act_before, now))),
    )
    rows = near.select(*keys, F.explode(sources).alias("s")).select(*keys, "s.*")
    return rows.where(F.col("values").isNotNull())


VALUE_QUANTILES = {VALUE: PERCENTILES, SIZE: {f"abs_{k}": p for k, p in TAILS.items()}}
DELTA_QUANTILES = {SIZE: {f"abs_delta_{k}": p for k, p in TAILS.items()}}


def _value_columns(quantiles=VALUE_QUANTILES) -> list[Column]:
    """The columns of A1 from a profile."""
    m = F.col("moments")
    names = [n for wanted in quantiles.values() for n in wanted]
    return [
        (m["count"] + m["nonfinite"]).alias("sample_count"),
        m["count"].alias("finite_count"),
        m["nonfinite"].alias("nonfinite_count"),
        *[m[n].alias(n) for n in ("min", "max", "mean", "std")],
        _mean_of(m["abs_sum"]).alias("abs_mean"),
        m["abs_max"].alias("abs_max"),
        *[F.col(n) for n in names],
    ]


def _delta_columns() -> list[Column]:
    """The columns of A2 from a profile."""
    m = F.col("moments")
    return [
        (m["count"] + m["nonfinite"]).alias("delta_sample_count"),
        m["count"].alias("delta_finite_count"),
        m["nonfinite"].alias("delta_nonfinite_count"),
        _mean_of(m["abs_sum"]).alias("abs_delta_mean"),
        m["abs_max"].alias("abs_delta_max"),
        *[F.col(n) for n in DELTA_QUANTILES[SIZE]],
    ]


def _mean_of(total: Column) -> Column:
    return F.when(F.col("moments")["count"] > 0, total / F.col("moments")["count"])


def _speeds(df: DataFrame, fps: float) -> DataFrame:
    return df.withColumns(
        {
            f"abs_velocity_{k}_rad_s": F.col(f"abs_delta_{k}") * F.lit(float(fps))
            for k in ("mean", "p95", "p99", "max")
        }
    )


def joint_statistics(df, by, value="value") -> DataFrame:
    """A1: counts, extremes, exact percentiles, mean, population std and the same of |x|.

    Non-finite samples are counted and left out.
    """
    found = profile(df.select(*by, value), by, value, VALUE_QUANTILES, finite=True, empty=True)
    return found.select(*by, *_value_columns())


def delta_statistics(df, by, delta="delta", fps: float | None = None) -> DataFrame:
    """A2: statistics of |delta|, and of the speed |delta| x fps."""
    found = profile(df.select(*by, delta), by, delta, DELTA_QUANTILES, finite=True, empty=True)
    out = found.select(*by, *_delta_columns())
    return out if fps is None else _speeds(out, fps)


def motion_statistics(df, by, fps: float, value="value", delta="delta") -> DataFrame:
    """A1 and A2 of the same rows together, in the passes of one."""
    kinds = F.array(*[F.struct(F.lit(k).alias("_kind"), F.col(c).alias("_x")) for k, c in (("value", value), ("delta", delta))])
    rows = df.select(*by, F.explode(kinds).alias("_k")).select(*by, "_k.*")
    found = profile(rows, [*by, "_kind"], "_x", VALUE_QUANTILES, finite=True, empty=True)
    # The tails of |x| have the same levels in both kinds; the kinds of a group meet in one row.
    tails = zip(VALUE_QUANTILES[SIZE], DELTA_QUANTILES[SIZE], strict=True)
    found = found.withColumns({new: F.col(old) for old, new in tails})
    kinds = {"value": F.struct(*_value_columns()), "delta": F.struct(*_delta_columns())}
    rows = found.groupBy(*by).agg(*[F.any_value(F.when(F.col("_kind") == k, c), F.lit(True)).alias(f"_{k}") for k, c in kinds.items()])
    return _speeds(rows.select(*by, "_value.*", "_delta.*"), fps)


def episode_stats(df, value="value", by=(*EPISODE, "feature", "dim")) -> DataFrame:
    """A4: min, max, mean, std, count and five quantiles per episode and feature."""
    by = list(by)
    found = profile(df.select(*by, value), by, value, {VALUE: EPISODE_QUANTILES}, empty=True)
    m = F.col("moments")
    return found.select(*by, *[m[n].alias(n) for n in ("min", "max", "mean", "std", "count")], *EPISODE_QUANTILES)


def merge_stats(stats: DataFrame, by=("feature", "dim")) -> DataFrame:
    """A5: pooled statistics of per-episode ones.

    The merged quantiles are count-weighted averages of the episode quantiles, not
    quantiles of the pooled rows. A quantile missing in any input is null.
    """
    by = list(by)
    n, mean, std = F.col("count"), F.col("mean"), F.col("std")
    total = F.sum(n)
    first = stats.groupBy(*by).agg((F.sum(mean * n) / total).alias("_mean"))
    averages = [
        F.when(F.count(q) == F.count(F.lit(1)), F.sum(F.col(q) * n) / total).alias(q)
        for q in EPISODE_QUANTILES
        if q in stats.columns
    ]
    return (
        match(stats, sized(first), by)
        .groupBy(*by)
        .agg(
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.max("_mean").alias("mean"),
            F.sqrt(F.sum((std * std + (mean - F.col("_mean")) * (mean - F.col("_mean"))) * n) / total)
            .alias("std"),
            total.alias("count"),
            *averages,
        )
    )


def relative_action_stats(
    df, action="action", state="state", by=EPISODE, order="frame_index", horizon=32
) -> DataFrame:
    """action(t+k) - state(t) per joint and k, over rows with the full horizon ahead."""
    found = offset_profile(df, action, state, by, order, horizon, {VALUE: {"q01": 0.01, "q99": 0.99}})
    m = F.col("moments")
    return found.select(
        "joint_index", "k", m["count"].alias("sample_count"), *[m[n].alias(n) for n in ("mean", "std", "min", "max")], "q01", "q99"
    )


def relative_sample_count(episodes: DataFrame, horizon=32, by=("dataset", "split")) -> DataFrame:
    """Sum of max(0, L - horizon + 1)."""
    room = F.greatest(F.col("length") - (horizon - 1), F.lit(0))
    return episodes.groupBy(*by).agg(F.sum(room).cast("long").alias("sample_count"))


def dataset_totals(episodes: DataFrame, tasks: DataFrame, chunks_size=1000, cameras=1, by=("dataset",)):
    """Episodes, frames, tasks, chunks, videos and the split range of a dataset."""
    by = list(by)
    sizes = episodes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_episodes"), F.sum("length").cast("long").alias("total_frames")
    )
    named = tasks.groupBy(*by).agg(F.count(F.lit(1)).alias("total_tasks"))
    return match(sizes, named, by, "left").withColumns(
        {
            "total_tasks": F.coalesce("total_tasks", F.lit(0).cast("long")),
            "total_chunks": F.ceil(F.col("total_episodes") / chunks_size).cast("long"),
            "total_videos": (F.col("total_episodes") * cameras).cast("long"),
            "split_range": F.format_string("0:%d", "total_episodes"),
        }
    )


def split_counts(records: DataFrame, split="split", session="source_session", goal="goal", component="source_dataset"):
    """Episodes, sessions and goals per split, per (split, goal) and (split, component)."""
    levels = F.array(
        F.struct(F.lit("split").alias("level"), F.lit("all").alias("member")),
        F.struct(F.lit("goal").alias("level"), F.col(goal).alias("member")),
        F.struct(F.lit("component").alias("level"), F.col(component).alias("member")),
    )
    rows = records.select(
        F.col(split).alias("split"),
        F.col(session).alias("_session"),
        F.col(goal).alias("_goal"),
        F.explode(levels).alias("_l"),
    )
    # One row per distinct (session, goal) first, so no distinct set gathers a split.
    pairs = rows.groupBy("split", "_l", "_session", "_goal").agg(F.count(F.lit(1)).alias("_n"))
    keys = ["split", "level", "member"]
    return (
        pairs.select("split", "_l.level", "_l.member", "_session", "_goal", "_n")
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("episodes"),
            F.count_distinct("_session").alias("sessions"),
            F.count_distinct("_goal").alias("goals"),
        )
    )


def exploded(df: DataFrame, *vectors: str, keys=EPISODE) -> DataFrame:
    """Long ``(keys, feature, dim, value)`` rows of vector columns."""
    parts = [
        explode_joints(df.select(*keys, v), v).select(
            *keys, F.lit(v).alias("feature"), F.col("joint_index").alias("dim"), "value"
        )
        for v in vectors
    ]
    return pool_sources(*parts)
