"""Exact linear quantiles, with counts and moments, without gathering a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.shared import BROADCAST_ROWS, sized

CELLS = 256  # cells per power of two
INFINITE, NAN, EMPTY = 1 << 40, 1 << 41, 1 << 42  # cells of their own at the ends
VALUE, SIZE = "value", "size"  # views: the value itself and its absolute value


def match(left: DataFrame, right: DataFrame, keys, how="inner") -> DataFrame:
    """Join on equal keys where null equals null."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if not keys:
        return left.join(renamed, F.lit(True), how)
    test = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, test, how).drop(*[f"_r_{k}" for k in keys])


def _cell(value: Column, size: Column) -> Column:
    """A log-linear histogram cell; never falls as the value grows. ``size`` is its absolute value."""
    power = F.floor(F.log2(size))
    inside = F.floor((size / F.pow(F.lit(2.0), power) - 1) * CELLS)
    # Only the last branch computes; the others keep it from values that it cannot hold.
    cell = (
        F.when(value.isNull(), F.lit(EMPTY))
        .when(F.isnan(value), F.lit(NAN))
        .when(size == float("inf"), F.lit(INFINITE))
        .when(size < 1e-300, F.lit(0))
        .otherwise((power + 1100) * CELLS + inside)
    )
    return F.when(value < 0, -cell).otherwise(cell)


def _center(cell: str) -> Column:
    """The lower edge of a cell's sizes, exact; 0 for cells of no number."""
    place = F.abs(cell)
    edge = F.pow(F.lit(2.0), F.expr(f"abs({cell}) div {CELLS}") - 1100) * (1 + (place % CELLS) / F.lit(float(CELLS)))
    return F.when((place > 0) & (place < INFINITE), edge).otherwise(0.0)


def _ranks(p: float, count: Column) -> tuple[Column, Column, Column]:
    at = (count - 1) * F.lit(float(p))
    return at, F.floor(at), F.ceil(at)


def _holds(rank: Column, first: Column, width: Column) -> Column:
    return (rank >= first) & (rank < first + width)


def cell_sums(number, total, over, over2, low, high) -> list[Column]:
    """What a cell holds: count, sum, sums of sizes and their squares above the cell's edge, extremes. All but the last two add up."""
    return [number.alias("_m"), total.alias("_v"), over.alias("_over"), over2.alias("_over2"), low.alias("_low"), high.alias("_high")]


def merged_cells(cells: DataFrame, by) -> DataFrame:
    """Cells that repeat as one."""
    return cells.groupBy(*by, "_cell").agg(*cell_sums(*[F.sum(c) for c in ("_m", "_v", "_over", "_over2")], F.min("_low"), F.max("_high")))


def in_cells(df: DataFrame, others, value: str, views, weight: str | None = None) -> DataFrame:
    """``others`` with the value ``_v``, its size, weight ``_n`` and ``_cell``."""
    number = F.col(weight) if weight else F.lit(1).cast("long")
    rows = df.select(*others, F.col(value).cast("double").alias("_v"), number.alias("_n"))
    rows = rows.withColumn("_size", F.abs("_v"))
    rows = rows.withColumns({"_cell": _cell(F.col("_v"), F.col("_size")), "_n": F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)})
    # Where only sizes are ordered, both signs share a cell.
    return rows if VALUE in views else rows.withColumn("_cell", F.abs("_cell"))


def counted_cells(rows: DataFrame, by, *more: Column) -> DataFrame:
    """Rows of ``in_cells`` as cells, with ``more`` aggregates."""
    above = F.col("_above")
    held = cell_sums(F.sum("_n"), F.sum("_v"), F.sum(above), F.sum(above * above), F.min("_v"), F.max("_v"))
    return rows.withColumn("_above", F.col("_size") - _center("_cell")).groupBy(*by, "_cell").agg(*held, *more)


def fanned(df: DataFrame, fan_out: Column) -> DataFrame:
    """One row per struct of ``fan_out``, its fields as columns."""
    return df.withColumn("_s", F.explode(fan_out)).select("*", "_s.*").drop("_s")


def fanned_hits(rows: DataFrame, by, fan_out: Column, hits: DataFrame) -> DataFrame:
    """``hits`` with their rows; only rows in a cell that some group wants are fanned out."""
    wanted = rows.join(sized(hits.select("_cell").distinct()), "_cell", "left_semi")
    return match(fanned(wanted, fan_out).select(*by, "_v", "_size", "_n", "_cell"), hits, [*by, "_cell"])


def profile(
    df: DataFrame,
    by,
    value: str,
    views: dict[str, dict[str, float]],
    weight: str | None = None,
    fan_out: Column | None = None,
    finite: bool = False,
    empty: bool = False,
) -> DataFrame:
    """One row per group: the struct ``moments`` and the linear-interpolated quantiles.

    ``views`` names quantiles of the ``value`` and of its absolute value (``size``).
    ``moments`` has count, nonfinite, sum, abs_sum, square_sum, min, max, abs_max, mean and
    std (population; where the value itself is viewed), of rows without ``weight``. With ``finite`` other values are counted as nonfinite and left out of
    all else; without it a group with NaN has NaN for all quantiles and infinities stand
    at the ends, where between two equal neighbours the quantile is their value. Nulls are
    left out; ``empty`` keeps groups that have nothing else.

    1. values fall into histogram cells, each with its count, sums above its edge and extremes,
       combined before the shuffle: what is moved is bounded by groups x cells, whatever
       the number of rows;
    2. the cells of a group give its moments and locate the cells that hold the wanted
       ranks: one row per group (checkpointed, at most two cells per quantile);
    3. only rows in those cells are counted per value, ordered and read off. A value
       that fills a third of the rows is one row per task there.

    ``fan_out`` is an array of structs that adds ``by`` columns, such as several
    scopes for one row. Cells, not rows, are fanned out in the first step.
    """
    by = list(by)
    fine = by if fan_out is None else [c for c in df.columns if c not in (value, weight)]
    rows = in_cells(df, fine, value, views, weight)
    if not empty:
        rows = rows.where(F.col("_v").isNotNull())
    cells = counted_cells(rows, fine)
    if fan_out is not None:
        cells = merged_cells(fanned(cells, fan_out), by)

    def of(hits: DataFrame) -> DataFrame:
        if fan_out is not None:
            return fanned_hits(rows, by, fan_out, hits)
        return match(rows.select(*by, "_v", "_size", "_n", "_cell"), hits, [*by, "_cell"])

    return settle(cells, by, views, finite, of)


def settle(cells: DataFrame, by, views, finite: bool, values_of) -> DataFrame:
    """The result of ``profile`` from the cells and, for the cells that hold the wanted ranks, their values.

    ``cells``: ``by, _cell`` once each, with the columns of ``cell_sums``. ``values_of(hits)`` joins
    ``_v, _size, _n`` to the hits by cell.
    """
    by = list(by)
    summary = sized(_summary(cells, by, views, finite))
    hits = summary.select(*by, F.col("moments.count").alias("_all"), F.explode("_hits").alias("_h")).select(*by, "_all", "_h.*")

    chosen = values_of(hits)
    seen = F.when(F.col("view") == SIZE, F.col("_size")).otherwise(F.col("_v"))
    keys = [*by, "_all", "view", "place", "before"]
    chosen = chosen.withColumn("_v", seen).groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"))
    order = Window.partitionBy(*by, "view", "place").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("_n").over(order), F.lit(0))
    chosen = chosen.withColumn("_first", first)

    aggregates = []
    for view, wanted in views.items():
        for name, p in wanted.items():
            at, low, high = _ranks(p, F.col("_all"))
            here = F.col("view") == view
            for side, rank in (("low", low), ("high", high)):
                held = here & _holds(rank, F.col("_first"), F.col("_n"))
                aggregates.append(F.max(F.when(held, F.col("_v"))).alias(f"_{side}_{name}"))
            aggregates.append(F.max(at - low).alias(f"_part_{name}"))
    read = chosen.groupBy(*by).agg(*aggregates)

    def quantile(name: str) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        between = F.when(low == high, low).otherwise(low + (high - low) * F.col(f"_part_{name}"))
        return F.when(F.col("_nan"), F.lit(float("nan"))).otherwise(between)

    names = [n for wanted in views.values() for n in wanted]
    return match(summary, read, by, "left").select(*by, "moments", *[quantile(n).alias(n) for n in names])


def _step(size: Column) -> Column:
    """A power of two of which sums up to ``size`` are exact multiples with 40 bits; null where there is none."""
    return F.when((size > 1e-250) & (size < 1e300), F.pow(F.lit(2.0), F.ceil(F.log2(size)) - 40))


def _total(value: Column, step: Column) -> Column:
    """The sum in two parts, multiples of ``step`` (exact) and the rest, so that the order of cells does not show."""
    whole = F.rint(value / step) * step
    return F.sum(F.when(step.isNull(), value).otherwise(whole)) + F.sum(F.when(step.isNull(), F.lit(0.0)).otherwise(value - whole))


def _summary(cells: DataFrame, by, views, finite: bool) -> DataFrame:
    """by, moments, whether NaN decides the quantiles, and the cells with the wanted ranks."""
    number, place = F.col("_m"), F.abs("_cell")
    used = number if not finite else F.when(place < INFINITE, number).otherwise(0)
    signed = VALUE in views
    sign = F.when(F.col("_cell") < 0, -1.0).otherwise(1.0)
    cells = cells.withColumns({"_used": used, "_edge": _center("_cell"), "_sign": sign if signed else F.lit(1.0)})
    edge, over = F.col("_edge"), F.col("_over")
    counts = F.col("_used") > 0
    sizes = number * edge + over
    squares = F.col("_over2") + 2 * edge * over + number * edge * edge
    added = {"_sum": F.col("_sign") * sizes if signed else F.col("_v"), "_abs": sizes, "_square": squares}
    cells = cells.withColumns({n: F.when(counts, c) for n, c in added.items()})
    group = Window.partitionBy(*by)
    before = Window.unboundedPreceding, -1
    n = F.sum("_used")
    columns = {"_count": n.over(group), "_mean": F.sum("_sum").over(group) / n.over(group)}
    columns |= {f"_step{c}": _step(F.sum(F.abs(c)).over(group)) for c in added}
    for view in views:
        # The sizes of both signs of a place lie in one stretch of the order.
        order = group.orderBy("_cell") if view == VALUE or not signed else group.orderBy(place, "_cell")
        first = F.coalesce(n.over(order.rowsBetween(*before)), F.lit(0))
        if view == SIZE and signed:
            back = F.when(F.abs(F.lag("_cell").over(order)) == place, F.lag("_used").over(order))
            ahead = F.when(F.abs(F.lead("_cell").over(order)) == place, F.lead("_used").over(order))
            back, ahead = F.coalesce(back, F.lit(0)), F.coalesce(ahead, F.lit(0))
            columns |= {"_before_size": first - back, "_width_size": F.col("_used") + back + ahead}
        else:
            columns |= {f"_before_{view}": first, f"_width_{view}": F.col("_used")}
    cells = cells.withColumns(columns)
    hits = []
    for view, wanted in views.items():
        first, width = F.col(f"_before_{view}"), F.col(f"_width_{view}")
        ranks = [r for p in wanted.values() for r in _ranks(p, F.col("_count"))[1:]]
        held = reduce(lambda a, b: a | b, [_holds(r, first, width) for r in ranks])
        hit = F.struct(F.lit(view).alias("view"), "_cell", (F.col("_cell") if view == VALUE else place).alias("place"), first.alias("before"))
        hits.append(F.collect_list(F.when(held & counts, hit)))
    part = lambda c: F.when(counts, c)
    apart = edge - F.col("_sign") * F.col("_mean")
    totals = {name: _total(F.col(name), F.col(f"_step{name}")) for name in added}
    spread = F.sqrt(F.sum(part(F.col("_over2") + 2 * apart * over + number * apart * apart)) / n)
    moments = F.struct(
        n.alias("count"),
        F.sum(number - F.col("_used")).alias("nonfinite"),
        totals["_sum"].alias("sum"),
        totals["_abs"].alias("abs_sum"),
        totals["_square"].alias("square_sum"),
        F.min(part(F.col("_low"))).alias("min"),
        F.max(part(F.col("_high"))).alias("max"),
        F.max(part(F.greatest(F.abs("_low"), F.abs("_high")))).alias("abs_max"),
        (totals["_sum"] / n).alias("mean"),
        (spread if signed else F.lit(None).cast("double")).alias("std"),
    )
    nan = F.coalesce(F.max(part(F.col("_cell") == NAN)), F.lit(False))
    return cells.groupBy(*by).agg(moments.alias("moments"), nan.alias("_nan"), F.flatten(F.array(*hits)).alias("_hits"))


def exact_quantiles(df: DataFrame, by, value: str, probabilities: dict[str, float], weight: str | None = None, fan_out: Column | None = None) -> DataFrame:
    """One row per group with the quantiles of ``value``, as in ``profile``."""
    return profile(df, by, value, {VALUE: probabilities}, weight, fan_out).drop("moments")
