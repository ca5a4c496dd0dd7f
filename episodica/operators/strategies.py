"""Strategies after a stale state: windows, metrics, summaries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.operators.bootstrap import cluster_interval
from episodica.operators.ordered import index_block
from episodica.operators.quantiles import exact_quantiles, fanned, match
from episodica.shared import checkpointed, sized, stored

HOLD = "hold_pre_dropout"
CONTINUE = "continue_previous_chunk"
STALE = "stale_state_inference"


def strategy_windows(
    decisions: DataFrame,
    horizon: int,
    stale="stale_chunk",
    fresh="fresh_chunk",
    held="pre_dropout_command",
    offset="decision_offset",
) -> DataFrame:
    """The three ``horizon``-step windows of a decision, one row per strategy.

    Chunks are arrays of action vectors; a window of another length fails the task.
    """
    windows = windows_of(horizon, stale, fresh, held, offset)
    rows = F.array(
        *[F.struct(F.lit(n).alias("strategy"), w.alias("window")) for n, w in windows.items()]
    )
    out = decisions.withColumn("_s", F.explode(rows)).select(*decisions.columns, "_s.*")
    return out.withColumn("window", whole_window(F.col("window"), horizon, out.schema["window"].dataType.simpleString()))


def windows_of(horizon: int, stale="stale_chunk", fresh="fresh_chunk", held="pre_dropout_command", offset="decision_offset") -> dict[str, Column]:
    """The window of each strategy."""
    return {
        STALE: F.slice(stale, 1, horizon),
        HOLD: F.array_repeat(F.col(held), horizon),
        CONTINUE: F.slice(fresh, F.col(offset) + 1, F.lit(horizon)),
    }


def whole_window(window: Column, horizon: int, kind: str) -> Column:
    """The window, which must have ``horizon`` steps."""
    return F.when(F.size(window) == horizon, window).otherwise(F.raise_error(F.lit("window has another length")).cast(kind))


def window_rows(windows: DataFrame) -> DataFrame:
    """Long rows ``(horizon_position, joint_index, prediction)`` of the windows."""
    others = [c for c in windows.columns if c != "window"]
    steps = windows.select(*others, F.posexplode("window").alias("horizon_position", "_step"))
    return steps.select(
        *others, "horizon_position", F.posexplode("_step").alias("joint_index", "prediction")
    )


def within_window_slew(rows: DataFrame, keys, value="prediction") -> DataFrame:
    """Absolute step change inside a window; null on its first step.

    ``keys`` name one window and joint, so a group is never longer than the horizon.
    """
    order = Window.partitionBy(*keys).orderBy("horizon_position")
    return rows.withColumn("slew", F.abs(F.col(value) - F.lag(value).over(order)))


def strategy_metrics(rows: DataFrame, window_keys, group: str = "group") -> DataFrame:
    """Errors, entry jumps and slew per decision, strategy and group.

    ``rows`` hold ``prediction, expert, fresh_command, previous_command`` per
    (window, position, joint); ``window_keys`` name the window with its strategy.
    """
    window_keys = list(window_keys)
    rows = within_window_slew(rows, [*window_keys, group, "joint_index"])
    error = F.col("prediction") - F.col("expert")
    entry = F.col("horizon_position") == 0

    def jump(command: str) -> Column:
        return F.avg(F.when(entry, F.abs(F.col("prediction") - F.col(command))))

    return (
        rows.groupBy(*window_keys, group)
        .agg(
            F.count(error).alias("sample_count"),
            F.sum(F.abs(error)).alias("sum_absolute_error"),
            F.sum(error * error).alias("sum_squared_error"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"),
            F.avg(error).alias("bias"),
            F.max(F.abs(error)).alias("max_absolute_error"),
            jump("fresh_command").alias("jump_from_fresh_proxy_command_mae"),
            jump("previous_command").alias("entry_jump_from_strategy_history_mae"),
            F.coalesce(F.avg("slew"), F.lit(0.0)).alias("within_window_mean_absolute_slew"),
            F.coalesce(F.max("slew"), F.lit(0.0)).alias("within_window_max_absolute_slew"),
        )
        .withColumn("rmse", F.sqrt("mse"))
    )


METRICS = (
    "sample_count", "sum_absolute_error", "sum_squared_error", "mae", "mse", "bias", "max_absolute_error",
    "jump_from_fresh_proxy_command_mae", "entry_jump_from_strategy_history_mae",
    "within_window_mean_absolute_slew", "within_window_max_absolute_slew", "rmse",
)

def _array_of(*names: str) -> str:
    """Type of an array of metric rows."""
    kinds = {"strategy": "string", "group": "string", "sample_count": "bigint"}
    return "array<struct<" + ", ".join(f"{n}: {kinds.get(n, 'double')}" for n in names) + ">>"


def _places(lists):
    """Of each element of a list array its row, its place in the row's list and its place in the values."""
    offsets = lists.offsets.to_numpy()
    size = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    row = np.repeat(np.arange(len(lists)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    return row, place, place + np.repeat(offsets[:-1], size)


def _width(place) -> int:
    return int(place.max()) + 1 if len(place) else 0


def _matrix(vectors):
    """Vectors as rows of one array with their values, null or not, filled up to the longest."""
    row, place, at = _places(vectors)
    values = np.zeros((len(vectors), _width(place)))
    known = np.zeros(values.shape, bool)
    values[row, place] = vectors.values.to_numpy(zero_copy_only=False)[at]
    known[row, place] = vectors.values.is_valid().to_numpy(zero_copy_only=False)[at]
    return values, known


def _cube(windows):
    """The same of lists of vectors: row, step, joint."""
    row, step, at = _places(windows)
    steps, known_steps = _matrix(windows.values)
    values = np.zeros((len(windows), _width(step), steps.shape[1]))
    known = np.zeros(values.shape, bool)
    values[row, step], known[row, step] = steps[at], known_steps[at]
    return values, known


def _fitted(values, known, shape):
    """Cut or filled up to ``shape``."""
    out, some = np.zeros(shape), np.zeros(shape, bool)
    part = tuple(slice(0, min(a, b)) for a, b in zip(shape, values.shape, strict=True))
    out[part], some[part] = values[part], known[part]
    return out, some


def _group_metrics(window, expert, fresh, previous, groups):
    """Metrics of the groups of each window of a batch: names of the groups, whether a window has them, and
    by metric the values and whether they are known, by window and group. Sums run by joint, then step."""
    value, known = _cube(window)
    rows, steps, joints = value.shape
    target, found = _fitted(*_cube(expert), value.shape)
    error, has_error = value - target, known & found
    slew, has_slew = np.abs(np.diff(value, axis=1)), known[:, 1:] & known[:, :-1]
    commands = [_fitted(*_matrix(x), (rows, joints)) for x in (fresh, previous)]
    entry, enters = (value[:, 0], known[:, 0]) if steps else (np.zeros((rows, joints)), np.zeros((rows, joints), bool))
    jumps = [(np.abs(entry - x)[:, None], (enters & k)[:, None]) for x, k in commands]

    row, joint, at = _places(groups)
    inner, _, name_at = _places(groups.values)
    where = np.full(len(groups.values), -1)
    where[at] = np.arange(len(at))
    names = groups.values.values.dictionary_encode()
    code, member = names.indices.to_numpy(), np.zeros((rows, max(joints, _width(joint)), len(names.dictionary)), bool)
    used = where[inner] >= 0
    mine = where[inner[used]]
    member[row[mine], joint[mine], code[name_at[used]]] = True

    def totals(of, has, g, largest=False):
        """Count, sum and largest of the known values of a group's joints."""
        count, total, most = np.zeros(rows, np.int64), np.zeros(rows), np.full(rows, -np.inf)
        for j in range(joints):
            for h in range(of.shape[1]):
                k = member[:, j, g] & has[:, h, j]
                count += k
                total += np.where(k, of[:, h, j], 0.0)
                if largest:
                    most = np.where(k, np.maximum(most, of[:, h, j]), most)
        return count, total, most

    def mean(count, total):
        return total / np.maximum(count, 1), count > 0

    columns, always = {n: [] for n in METRICS}, np.ones(rows, bool)
    absolute, squared = np.abs(error), error * error
    for g in range(member.shape[2]):
        n, sum_absolute, most = totals(absolute, has_error, g, True)
        _, sum_squared, _ = totals(squared, has_error, g)
        _, sum_error, _ = totals(error, has_error, g)
        slews, sum_slew, most_slew = totals(slew, has_slew, g, True)
        mse, some = mean(n, sum_squared)
        told = [
            (n, always), (sum_absolute, some), (sum_squared, some), mean(n, sum_absolute), (mse, some), mean(n, sum_error), (most, some),
            *[mean(*totals(x, k, g)[:2]) for x, k in jumps],
            (mean(slews, sum_slew)[0], always), (np.where(slews > 0, most_slew, 0.0), always), (np.sqrt(mse), some),
        ]
        for name, column in zip(METRICS, told, strict=True):
            columns[name].append(column)
    shape = rows, len(names.dictionary)
    tables = {n: tuple(np.stack(x, axis=1) if x else np.zeros(shape, bool) for x in (zip(*columns[n], strict=True) if columns[n] else ((), ()))) for n in METRICS}
    return names.dictionary, member.any(axis=1), tables


def _metric_rows(made: dict, hold: str | None = None):
    """The metric rows of each window as an array; with ``hold`` those of all strategies of ``made``, each with the hold strategy's MSE of its group."""
    there = np.concatenate([has for _, has, _ in made.values()], axis=1)
    offsets = pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]), pa.int32())
    place = pa.array(np.nonzero(there)[1])
    groups = [names.to_pylist() for names, _, _ in made.values()]
    fields = {"group": pa.array([g for some in groups for g in some], pa.string()).take(place)}
    tables = {n: [tables[n] for _, _, tables in made.values()] for n in METRICS}
    if hold:
        fields = {"strategy": pa.array([n for n, some in zip(made, groups, strict=True) for _ in some], pa.string()).take(place)} | fields
        names, _, told = made[hold]
        at = {g: i for i, g in enumerate(names.to_pylist())}
        none = np.zeros(len(there)), np.zeros(len(there), bool)
        of = [[tuple(x[:, at[g]] for x in told["mse"]) if g in at else none for g in some] for some in groups]
        tables["hold_mse"] = [tuple(np.stack(x, axis=1) for x in zip(*some, strict=True)) for some in of if some]
    for name, parts in tables.items():
        values, some = (np.concatenate(x, axis=1)[there] for x in zip(*parts, strict=True)) if parts else (np.zeros(0), np.zeros(0, bool))
        fields[name] = pa.array(values, pa.int64() if name == "sample_count" else pa.float64(), mask=~some)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _inputs(window: Column, previous: Column, groups_of: Callable[[Column], Column]) -> list[Column]:
    joints = F.size(F.get(window, F.lit(0)))
    groups = F.when(joints > 0, F.transform(F.sequence(F.lit(0), joints - 1), groups_of))
    return [window.cast("array<array<double>>"), previous.cast("array<double>"), groups.cast("array<array<string>>")]


def _commands(expert: str, fresh: str) -> list[Column]:
    return [F.col(expert).cast("array<array<double>>"), F.col(fresh).cast("array<double>")]


def group_metrics(window: Column, expert: str, fresh: str, previous: Column, groups_of: Callable[[Column], Column]) -> Column:
    """A17 of one window: an array with the metrics of each group of its joints.

    ``window`` and ``expert`` are arrays of vectors, ``fresh`` and ``previous`` commands are
    vectors; ``groups_of(joint)`` is the array of a joint's groups. Positions beyond the expert window have no error.
    """

    def metrics(*of):
        expert, fresh, window, previous, groups = of
        return _metric_rows({"": _group_metrics(window, expert, fresh, previous, groups)})

    metrics.__annotations__ = {"of": pa.Array, "return": pa.Array}
    return F.arrow_udf(metrics, _array_of("group", *METRICS))(*_commands(expert, fresh), *_inputs(window, previous, groups_of))


def baseline_metrics(windows: dict[str, Column], expert: str, fresh: str, previous: dict[str, Column], groups_of: Callable[[Column], Column]) -> Column:
    """The same of all strategies of one decision, each row with its strategy and ``hold_mse``."""
    names = list(windows)

    def metrics(*of):
        expert, fresh, *rest = of
        made = {}
        for i, name in enumerate(names):
            window, previous, groups = rest[3 * i : 3 * i + 3]
            made[name] = _group_metrics(window, expert, fresh, previous, groups)
        return _metric_rows(made, HOLD)

    metrics.__annotations__ = {"of": pa.Array, "return": pa.Array}
    inputs = [c for n in names for c in _inputs(windows[n], previous[n], groups_of)]
    return F.arrow_udf(metrics, _array_of("strategy", "group", *METRICS, "hold_mse"))(*_commands(expert, fresh), *inputs)


def window_metrics(windows: DataFrame, window_keys, groups_of: Callable[[Column], Column]) -> DataFrame:
    """A17 from whole windows, one row each: the metrics of its groups are made in its row, without a shuffle.

    ``windows`` hold ``window`` and ``expert_window`` (arrays of vectors), ``fresh_command`` and
    ``previous_command`` (vectors); ``groups_of`` is that of ``group_metrics``. Results are those of
    ``strategy_metrics`` over ``window_rows``.
    """
    window_keys = list(window_keys)
    made = group_metrics(F.col("window"), "expert_window", "fresh_command", F.col("previous_command"), groups_of)
    rows = windows.select(*window_keys, made.alias("_metrics"))
    return rows.select(*window_keys, F.explode("_metrics").alias("_m")).select(*window_keys, "_m.*")


PAIRED = ("checkpoint_step", "split", "event_id", "decision_offset", "noise_repeat", "group")


def join_hold_baseline(metrics: DataFrame, keys=PAIRED) -> DataFrame:
    """Every strategy row with the hold strategy's MSE on the same key.

    The key names one decision window, so a group holds its few strategies only; a
    second hold row on a key fails the task.
    """
    window = Window.partitionBy(*keys)
    is_hold = F.col("strategy") == HOLD
    holds = F.count_if(is_hold).over(window)
    hold = F.max(F.when(is_hold, F.col("mse"))).over(window)
    single = F.when(holds <= 1, hold).otherwise(
        F.raise_error(F.lit("several hold rows on one key")).cast("double")
    )
    out = metrics.withColumn("hold_mse", single)
    return out.withColumn("mse_delta_vs_hold", F.col("mse") - F.col("hold_mse"))


MEANS = {
    "mae": "mean_event_mae",
    "mse": "mean_event_mse",
    "jump_from_fresh_proxy_command_mae": "mean_jump_from_fresh_proxy_command_mae",
    "entry_jump_from_strategy_history_mae": "mean_entry_jump_from_strategy_history_mae",
    "within_window_mean_absolute_slew": "within_window_mean_absolute_slew",
    "mse_delta_vs_hold": "mse_delta_vs_hold",
    "_win": "event_win_rate_vs_hold",
}
SUMS = ("sample_count", "sum_absolute_error", "sum_squared_error")
FIRST = "first_of_event"


def strategy_summary(
    metrics: DataFrame, replicates: int = 1000, seed: int = 42, extra=(), block: Column | None = None
) -> DataFrame:
    """Summary per (checkpoint, split, offset, strategy, group) and window scope.

    ``extra`` adds strata whose nulls stay a group (A19). Metrics that have their ``hold_mse`` are
    taken as they are; where they tell the ``first_of_event`` rows, events are counted by them.
    """
    fine = ["checkpoint_step", "split", *extra, "decision_offset", "strategy", "group"]
    keys = [*fine, "window_scope"]

    def scopes(every: Column, stale: Column, has: Column) -> Column:
        """Rows of the two scopes; rows of whole stale windows are in both."""
        named = [x.withField("window_scope", F.lit(n)) for x, n in ((every, "all_windows"), (stale, "full_stale_window"))]
        return F.array_compact(F.array(named[0], F.when(has, named[1])))

    none = F.struct(F.lit(None).cast("string").alias("window_scope"))
    fan_out = scopes(none, none, F.col("window_all_stale"))
    known = metrics if "hold_mse" in metrics.columns else join_hold_baseline(metrics)
    known = known.withColumn("mse_delta_vs_hold", F.col("mse") - F.col("hold_mse"))
    win = F.when(F.col("mse") < F.col("hold_mse"), 1.0).otherwise(0.0)
    known = known.withColumn("_win", F.when(F.col("strategy") != HOLD, win))
    first = [FIRST] if FIRST in known.columns else []
    # Metric rows are read many times, a few columns each time: they are stored as columns.
    rows = stored(known.select(*fine, "window_all_stale", "episode_index", "event_id", *first, *SUMS, *MEANS), "metrics")

    # Sums and counts of rows add up, so scopes are made of the few groups, not of the rows.
    added = [F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in SUMS]]
    added += [f(c).alias(f"_{f.__name__}_{c}") for c in MEANS for f in (F.sum, F.count)]
    out = fanned(rows.groupBy(*fine, "window_all_stale").agg(*added), fan_out)
    n = F.sum("sample_count")
    out = out.groupBy(*keys).agg(
        F.sum("_rows").alias("noise_samples"),
        n.alias("scalar_predictions"),
        (F.sum("sum_absolute_error") / n).alias("micro_mae"),
        (F.sum("sum_squared_error") / n).alias("micro_mse"),
        F.sqrt(F.sum("sum_squared_error") / n).alias("micro_rmse"),
        *[F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_count_{c}")).alias(name) for c, name in MEANS.items()],
    )
    # One row per episode and scope: its events, and its sums for the draws.
    stale = F.col("window_all_stale")
    measures = {"_s": (F.sum, F.col("mse_delta_vs_hold")), "_n": (F.count, F.col("mse_delta_vs_hold"))}
    if first:
        measures["_e"] = F.sum, F.col(FIRST).cast("long")
    per = [f(c).alias(f"{name}_all") for name, (f, c) in measures.items()]
    per += [f(F.when(stale, c)).alias(f"{name}_stale") for name, (f, c) in measures.items()]
    per = rows.groupBy(*fine, "episode_index").agg(*per, F.max(stale).alias("_has"))
    both = [F.struct(*[F.col(f"{m}_{end}").alias(m) for m in measures]) for end in ("all", "stale")]
    per = per.withColumn("_s", F.explode(scopes(*both, F.coalesce("_has", F.lit(False))))).select(*fine, "episode_index", "_s.*")
    per = stored(per, "episodes")
    episodes = F.count(F.lit(1)).alias("episodes")
    if first:
        events = per.groupBy(*keys).agg(episodes, F.sum("_e").cast("long").alias("events"))
    else:
        events = fanned(rows.select(*fine, "window_all_stale", "episode_index", "event_id"), fan_out)
        events = events.groupBy(*keys, "episode_index", "event_id").agg(F.lit(1).alias("_e"))
        events = events.groupBy(*keys, "episode_index").agg(F.count(F.lit(1)).alias("_e"))
        events = events.groupBy(*keys).agg(episodes, F.sum("_e").cast("long").alias("events"))
    # Each part is made by itself, as one plan for all of them, told anew with every stage, fills the driver.
    out = match(checkpointed(out), sized(events), keys)
    for name in ("mae", "mse"):
        values = rows.select(*fine, "window_all_stale", name)
        medians = exact_quantiles(values, keys, name, {f"median_event_{name}": 0.5}, fan_out=fan_out)
        out = match(out, sized(medians), keys, "left")
    if replicates:
        block = index_block("episode_index") if block is None else block
        interval = cluster_interval(per.select(*keys, "episode_index", "_s", "_n"), block, replicates, seed, keys)
        names = {c: f"mse_delta_vs_hold_{c}" for c in ("ci95_low", "ci95_high")}
        out = match(out, sized(interval.withColumnsRenamed(names)), keys, "left")
    return out


def strategy_summary_by(metrics: DataFrame, stratum: str, **options) -> DataFrame:
    """A18 within event class, moving hand or source."""
    return strategy_summary(metrics, extra=(stratum,), **options)
