"""Prediction errors against recorded values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordered import index_block, marked, previous_row
from episodica.operators.quantiles import (
    EMPTY, SIZE, VALUE, counted_cells, fanned, fanned_hits, in_cells, match, merged_cells, profile, settle,
)
from episodica.shared import checkpointed, sized, stored

PAIR = ["intact", "counterfactual"]


def _sums(error: Column) -> list[Column]:
    return [
        F.count(error).alias("sample_count"),
        F.sum(F.abs(error)).alias("sum_absolute_error"),
        F.sum(error * error).alias("sum_squared_error"),
        F.sum(error).alias("sum_error"),
        F.max(F.abs(error)).alias("max_absolute_error"),
    ]


def _means(df: DataFrame) -> DataFrame:
    n = F.col("sample_count")
    return df.withColumns(
        {
            "mae": F.col("sum_absolute_error") / n,
            "mse": F.col("sum_squared_error") / n,
            "rmse": F.sqrt(F.col("sum_squared_error") / n),
            "bias": F.col("sum_error") / n,
        }
    )


SUMS = ("sample_count", "sum_absolute_error", "sum_squared_error", "sum_error", "max_absolute_error")
MEANS = ("mae", "mse", "rmse", "bias")
TYPICAL = {"median_absolute_error": 0.5, "p95_absolute_error": 0.95}


def _from_profile(found: DataFrame, by) -> DataFrame:
    m = F.col("moments")
    sums = {"sample_count": "count", "sum_absolute_error": "abs_sum", "sum_squared_error": "square_sum", "sum_error": "sum"}
    named = [m[n].alias(c) for c, n in sums.items()] + [m["abs_max"].alias("max_absolute_error")]
    return _means(found.select(*by, *named, *TYPICAL))


def error_metrics(df, by, prediction="prediction", expert="expert", quantiles=True) -> DataFrame:
    """Counts, sums, MAE, MSE, RMSE, bias, largest, median and 95 % absolute error."""
    by = list(by)
    error = F.col(prediction) - F.col(expert)
    if not quantiles:
        return _means(df.groupBy(*by).agg(*_sums(error)))
    found = profile(df.select(*by, error.alias("_error")), by, "_error", {SIZE: TYPICAL}, empty=True)
    return _from_profile(found, by)


def prediction_change(df, by, intact="intact", counterfactual="counterfactual") -> DataFrame:
    """Sum, mean and largest absolute difference of two predictions."""
    change = F.abs(F.col(counterfactual) - F.col(intact))
    return df.groupBy(*by).agg(
        F.sum(change).alias("sum_absolute_prediction_change"),
        F.avg(change).alias("mean_absolute_prediction_change"),
        F.max(change).alias("max_absolute_prediction_change"),
    )


def action_chunks(predictions: DataFrame, length="length", anchor="anchor_frame", position="horizon_position", horizon: int | None = None):
    """Prediction windows cut at the episode's end."""
    room = F.col(length) - F.col(anchor)
    limit = room if horizon is None else F.least(F.lit(horizon), room)
    return predictions.where(F.col(position) < limit)


def pair_conditions(predictions: DataFrame, keys, condition="condition", prediction="prediction", expert="expert"):
    """Intact and counterfactual predictions side by side, with the recorded value.

    Rows of the two conditions meet in one aggregation on the full key; keys that
    lack a condition are left out.
    """
    wide = predictions.groupBy(*keys).agg(
        *[F.max(F.when(F.col(condition) == c, F.col(prediction))).alias(c) for c in PAIR],
        F.max(expert).alias("expert"),
    )
    return wide.where(F.col("intact").isNotNull() & F.col("counterfactual").isNotNull())


def long_conditions(pairs: DataFrame) -> DataFrame:
    """Both conditions of a pair as rows ``(condition, prediction)``."""
    both = F.array(*[F.struct(F.lit(c).alias("condition"), F.col(c).alias("prediction")) for c in PAIR])
    others = [c for c in pairs.columns if c not in PAIR]
    return pairs.select(*others, F.explode(both).alias("_c")).select(*others, "_c.*")


def _whole_conditions(pairs: DataFrame, keys) -> DataFrame:
    """A8 per key and condition where a key has few rows: one aggregation by ``keys``."""

    def of(name: str) -> Column:
        error = F.col(name) - F.col("expert")
        ranks = F.percentile(F.abs(error), F.array(*[F.lit(p) for p in TYPICAL.values()]))
        # NaN decides the quantiles, as in ``profile``.
        ranks = F.when(F.coalesce(F.max(F.isnan(error)), F.lit(False)), F.array(*[F.lit(float("nan"))] * len(TYPICAL))).otherwise(ranks)
        return F.struct(F.lit(name).alias("condition"), *_sums(error), *[ranks[i].alias(c) for i, c in enumerate(TYPICAL)])

    both = pairs.groupBy(*keys).agg(F.array(*[of(c) for c in PAIR]).alias("_c"))
    rows = both.select(*keys, F.explode("_c").alias("_c")).select(*keys, "_c.*")
    return _means(rows).select(*keys, "condition", *SUMS, *MEANS, *TYPICAL)


def episode_condition_metrics(pairs: DataFrame, keys, hot: DataFrame | None = None) -> DataFrame:
    """A10: A8 per key and condition.

    With ``hot``, from ``ordered.hot_groups``, only those keys go through cells; the rows of
    any other key are few and meet in one aggregation.
    """
    keys = list(keys)
    if hot is None:
        return error_metrics(long_conditions(pairs), [*keys, "condition"])
    if hot.isEmpty():
        return _whole_conditions(pairs, keys)
    rows = marked(pairs, keys, hot)
    cut = error_metrics(long_conditions(rows.where("_hot")), [*keys, "condition"])
    return _whole_conditions(rows.where(~F.col("_hot")), keys).unionByName(cut)


def episode_pairs(pairs: DataFrame, keys) -> DataFrame:
    """A10: one row per key with both conditions, their deltas and the change; one pass.

    Means are sums over counts, so a group holds each of them once.
    """

    def of(name: str) -> list[Column]:
        error = F.col(name) - F.col("expert")
        return [
            F.sum(F.abs(error)).alias(f"{name}_sum_absolute_error"),
            F.sum(error * error).alias(f"{name}_sum_squared_error"),
            F.count(error).alias(f"_{name}_n"),
        ]

    change = F.abs(F.col("counterfactual") - F.col("intact"))
    out = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"),
        *of("intact"),
        *of("counterfactual"),
        F.sum(change).alias("sum_absolute_prediction_change"),
        F.count(change).alias("_change_n"),
        F.max(change).alias("max_absolute_prediction_change"),
    )

    def mean(total: str, number: str) -> Column:
        return (F.col(total) / F.col(number)).alias(total.replace("_sum_absolute_error", "_mae").replace("_sum_squared_error", "_mse").replace("sum_abs", "mean_abs"))

    def with_means(name: str) -> list[Column]:
        sums = [f"{name}_sum_absolute_error", f"{name}_sum_squared_error"]
        return [*[F.col(s) for s in sums], *[mean(s, f"_{name}_n") for s in sums]]

    out = out.select(
        *keys, "sample_count", *with_means("intact"), *with_means("counterfactual"), "sum_absolute_prediction_change",
        mean("sum_absolute_prediction_change", "_change_n"), "max_absolute_prediction_change",
    )
    return out.withColumns(
        {
            f"delta_{m}_counterfactual_minus_intact": F.col(f"counterfactual_{m}") - F.col(f"intact_{m}")
            for m in ("mae", "mse")
        }
    )


def scopes(task="task", cohort="cohort") -> Column:
    """All tasks, each task and each cohort; explode to fan rows out."""

    def scope(name, value):
        return F.struct(F.lit(name).alias("scope"), value.alias("scope_value"))

    return F.array(
        scope("all_tasks", F.lit("all")), scope("task", F.col(task)), scope("cohort", F.col(cohort))
    )


def _groups_of(groups: Column | None, joint: str) -> tuple[str, Column]:
    """The column that tells the groups of a row apart, and the array of its groups."""
    return ("group", F.array("group")) if groups is None else (joint, groups)


def condition_summary(
    pairs: DataFrame, keys=(), episode=("episode_index",), frame=("frame_index",), groups: Column | None = None, joint="joint_index"
) -> DataFrame:
    """A8 per scope, condition and group, with distinct episodes and frames.

    Cells with their sums and counts are formed once at (task, cohort) level and only those
    partial results are fanned out to the scopes; and to the groups, where these are given as
    an array that ``joint`` decides instead of a ``group`` on each row. Where each row of group
    "all" is a frame of its own, ``frame=()`` counts rows, which then need no number. ``pairs`` is
    made once: its columns are stored, and cells, wanted cells and frames read those they need.
    """
    parted, groups = _groups_of(groups, joint)
    keys, fine = list(keys), [*keys, "task", "cohort", "condition", parted]
    pairs = stored(pairs.select(*dict.fromkeys([*keys, "task", "cohort", parted, *episode, *frame, *PAIR, "expert"])), "pairs")
    scoped = [*keys, "scope", "scope_value", "condition", "group"]
    error = (F.col("prediction") - F.col("expert")).alias("_error")
    each = lambda s: F.transform(groups, lambda g: F.struct(s["scope"], s["scope_value"], g.alias("group")))
    out_to = F.flatten(F.transform(scopes(), each))
    rows = long_conditions(pairs).select(*fine, error)
    if parted == "group":
        out_to = scopes()
    found = profile(rows, scoped, "_error", {SIZE: TYPICAL}, fan_out=out_to, empty=True)
    totals = _from_profile(found, scoped)
    # Episodes and frames belong to the scope alone: distinct frames of group "all",
    # counted per episode, then episodes.
    whole = [*keys, "task", "cohort"]
    seen = pairs.where(F.array_contains(groups, "all"))
    if frame:
        seen = seen.groupBy(*whole, *episode, *frame).agg(F.lit(1).alias("_f"))
    seen = seen.groupBy(*whole, *episode).agg(F.count(F.lit(1)).alias("_f"))
    seen = seen.withColumn("_s", F.explode(scopes())).select("*", "_s.*")
    seen = seen.groupBy(*keys, "scope", "scope_value", *episode).agg(F.sum("_f").alias("_f"))
    seen = seen.groupBy(*keys, "scope", "scope_value").agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("_f").cast("long").alias("frames")
    )
    return match(totals, seen, [*keys, "scope", "scope_value"])


def horizon_summary(pairs: DataFrame, keys=(), groups: Column | None = None, joint="joint_index") -> DataFrame:
    """A8 per horizon position, condition and group; ``groups`` as in ``condition_summary``."""
    fine = [*keys, "horizon_position", "condition"]
    if groups is None:
        return error_metrics(long_conditions(pairs), [*fine, "group"])
    rows = long_conditions(pairs).select(*fine, joint, (F.col("prediction") - F.col("expert")).alias("_error"))
    out_to = F.transform(groups, lambda g: F.struct(g.alias("group")))
    return _from_profile(profile(rows, [*fine, "group"], "_error", {SIZE: TYPICAL}, fan_out=out_to, empty=True), [*fine, "group"])


def joint_summary(pairs: DataFrame, keys=()) -> DataFrame:
    """Per joint, both conditions, deltas and change; one pass, no pivot."""
    out = episode_pairs(pairs, [*keys, "joint_index"])
    return out.drop(
        *[f"{c}_sum_{s}_error" for c in PAIR for s in ("absolute", "squared")]
    )


def paired_effects(effects: DataFrame, keys=()) -> DataFrame:
    """Per scope and group, micro, episode-macro and task-balanced effects.

    ``effects`` has one row per (repeat, episode, group) as from ``episode_pairs``; an
    episode has one task and one cohort. Repeats are averaged per episode, episodes
    per task, tasks per scope. Only sums per (task, cohort, group) and cell are fanned out to
    the scopes. Episodes are not kept: sums and cells come from one pass over ``effects``,
    the values in the wanted cells and the repeats from two more.
    """
    fine, scoped = [*keys, "task", "cohort", "group"], [*keys, "scope", "scope_value", "group"]
    sums = [f"{c}_{s}" for c in PAIR for s in ("absolute", "squared")]
    per_episode = effects.groupBy(*fine, "episode_index").agg(
        F.avg("delta_mae_counterfactual_minus_intact").alias("delta_mae"),
        F.avg("mean_absolute_prediction_change").alias("change"),
        *[F.sum(f"{c}_sum_{s}_error").alias(f"{c}_{s}") for c in PAIR for s in ("absolute", "squared")],
        F.sum("sample_count").alias("samples"),
    )
    median = {VALUE: {"episode_macro_median_delta_mae": 0.5}}
    rows = in_cells(per_episode, [*fine, "change", *sums, "samples"], "delta_mae", median)
    cells = counted_cells(
        rows, fine,
        F.count(F.lit(1)).alias("_episodes"),
        F.sum("_v").alias("_delta"),
        F.sum("change").alias("_change"),
        F.count_if(F.col("_v") > 0).alias("_wins"),
        *[F.sum(n).alias(n) for n in sums],
        F.sum("samples").alias("samples"),
    )
    # At most groups x cells, whatever the number of episodes; read twice below.
    cells = checkpointed(cells)
    totals = ["_episodes", "_delta", "_change", "_wins", *sums, "samples"]
    parts = cells.groupBy(*fine).agg(*[F.sum(c).alias(c) for c in totals])
    per_task = fanned(parts, scopes()).groupBy(*scoped, "task").agg(*[F.sum(c).alias(c) for c in totals])
    n, k = F.sum("samples"), F.sum("_episodes")
    out = per_task.groupBy(*scoped).agg(
        k.alias("episodes"),
        F.count(F.lit(1)).alias("tasks"),
        (F.sum("intact_absolute") / n).alias("micro_intact_mae"),
        (F.sum("counterfactual_absolute") / n).alias("micro_counterfactual_mae"),
        ((F.sum("counterfactual_absolute") - F.sum("intact_absolute")) / n).alias("micro_delta_mae"),
        (F.sum("intact_squared") / n).alias("micro_intact_mse"),
        (F.sum("counterfactual_squared") / n).alias("micro_counterfactual_mse"),
        ((F.sum("counterfactual_squared") - F.sum("intact_squared")) / n).alias("micro_delta_mse"),
        (F.sum("_delta") / k).alias("episode_macro_mean_delta_mae"),
        F.avg(F.col("_delta") / F.col("_episodes")).alias("task_balanced_mean_delta_mae"),
        (F.sum("_wins") / k).alias("episode_win_rate_counterfactual_worse"),
        (F.sum("_change") / k).alias("episode_macro_prediction_change_mae"),
    )
    known = merged_cells(fanned(cells.where(F.col("_cell") != EMPTY), scopes()), scoped)
    middle = settle(known, scoped, median, False, lambda hits: fanned_hits(rows.select(*fine, "_v", "_size", "_n", "_cell"), scoped, scopes(), hits))
    middle = middle.drop("moments")
    repeats = effects.groupBy(*fine, "shuffle_repeat").agg(F.lit(1).alias("_one"))
    repeats = fanned(repeats, scopes()).groupBy(*scoped).agg(F.count_distinct("shuffle_repeat").alias("shuffle_repeats"))
    return match(match(out, middle, scoped), repeats, scoped)


def weighted_errors(df: DataFrame, keys=(), prediction="prediction", expert="expert") -> DataFrame:
    """Pooled, equal-episode and equal-task MAE per group.

    Needs ``task, episode_index, group``; one cascade of aggregates.
    """
    error = F.abs(F.col(prediction) - F.col(expert))
    episode = df.groupBy(*keys, "group", "task", "episode_index").agg(
        F.sum(error).alias("_s"), F.count(error).alias("_n")
    )
    task = episode.groupBy(*keys, "group", "task").agg(
        F.sum("_s").alias("_s"),
        F.sum("_n").alias("_n"),
        F.sum(F.col("_s") / F.col("_n")).alias("_e"),
        F.count(F.lit(1)).alias("_k"),
    )
    return task.groupBy(*keys, "group").agg(
        (F.sum("_s") / F.sum("_n")).alias("pooled_mae"),
        (F.sum("_e") / F.sum("_k")).alias("equal_episode_mae"),
        F.avg(F.col("_e") / F.col("_k")).alias("equal_task_mae"),
        F.sum("_k").alias("episodes"),
        F.count(F.lit(1)).alias("tasks"),
    )


def task_errors(df: DataFrame, keys=(), prediction="prediction", expert="expert") -> DataFrame:
    """Pooled MAE per task and group."""
    error = F.abs(F.col(prediction) - F.col(expert))
    return df.groupBy(*keys, "task", "group").agg(F.avg(error).alias("mae"), F.count(error).alias("samples"))


def model_wins(episode_mae: DataFrame, model="model", keys=("task", "episode_index"), mae="mae") -> DataFrame:
    """On how many episodes each model has the lowest MAE; ties count for all."""
    best = episode_mae.groupBy(*keys).agg(F.min(mae).alias("_best"))
    return (
        episode_mae.join(best, list(keys))
        .groupBy(model)
        .agg(
            F.count_if(F.col(mae) == F.col("_best")).alias("wins"),
            F.count(F.lit(1)).alias("episodes"),
        )
    )


def motion_split_errors(
    df: DataFrame, threshold: float, keys=(), by=("episode_index",), order=("frame_index",), block=None,
    prediction="prediction", expert="expert", anchor: str | None = None, hot: DataFrame | None = None,
) -> DataFrame:
    """Errors on active and on low motion frames, with predicted speed.

    A frame is active when the recorded value moved by at least ``threshold`` since
    the frame before. With ``anchor``, jumps at chunk starts are reported as well. With
    ``hot`` (keys, see ``ordered.hot_groups``) only those episodes are cut into blocks.
    """
    block = index_block(order[0]) if block is None else block
    near = previous_row(df, by, order, [expert, prediction], block, "_before_", hot=hot)
    moved = near.withColumns(
        {n: F.col(c) - F.col(f"_before_{c}") for n, c in (("_moved", expert), ("_speed", prediction))}
    )
    moved = moved.where(F.col("_moved").isNotNull()).withColumn(
        "motion", F.when(F.abs("_moved") >= threshold, F.lit("active")).otherwise(F.lit("low"))
    )
    error = F.col(prediction) - F.col(expert)
    edge = F.when(F.col(anchor) == F.col(order[0]), F.abs("_speed")) if anchor else None
    return moved.groupBy(*keys, "motion").agg(
        F.count(error).alias("samples"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs("_speed")).alias("mean_predicted_speed"),
        *([F.avg(edge).alias("mean_chunk_jump")] if anchor else []),
    )


def normalized_metrics(df, stats: DataFrame, by, joint="joint_index", prediction="prediction", expert="expert"):
    """A8 on values scaled by the caller's training ``(joint, offset, scale)``."""
    scaled = df.join(sized(stats.select(joint, "offset", "scale")), joint)
    scaled = scaled.withColumns(
        {c: (F.col(c) - F.col("offset")) / F.col("scale") for c in (prediction, expert)}
    )
    return error_metrics(scaled, by, prediction, expert)
