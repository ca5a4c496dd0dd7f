"""Order-dependent steps that stay distributed when one group is huge.

A plain ``Window.partitionBy(episode)`` sends a whole episode to one task. Here a
group is cut into blocks by a *monotone function of its leading order column*
(``frame_index div 65536``, a minute, a hash prefix). Each block is one window
partition; what crosses a block edge (a neighbour row, a running total, a run) travels
through a summary with a row or two per block. Results equal the plain window.

Keys and order columns must not be null, and ``order`` must be total in a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.contract import columns
from episodica.shared import checkpointed, sized

BLOCK_ROWS = 65536


def index_block(name: str, rows: int = BLOCK_ROWS) -> Column:
    """Block of an integer order column."""
    return F.expr(f"`{name}` div {rows}")


def hash_block(name: str, digits: int = 3) -> Column:
    """Block of a hex-digest order column."""
    return F.substring(name, 1, digits)


PARTITION_ROWS = 500_000


def spread(df: DataFrame, keys, rows: int) -> DataFrame:
    """``df`` dealt by ``keys`` over one partition per ``PARTITION_ROWS`` of ``rows``, where a shuffle has fewer.

    What a task then sorts or aggregates by ``keys`` stays the same as the input grows.
    """
    parts = -(-rows // PARTITION_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *columns(keys)) if parts > usual else df


def hot_groups(df: DataFrame, by, rows: int = BLOCK_ROWS) -> DataFrame:
    """Keys of the groups with over ``rows`` rows; counted at once, combined before the shuffle."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    return sized(counts.where(F.col("_rows") > rows).select(*by))


def marked(df: DataFrame, by, hot: DataFrame) -> DataFrame:
    """``df`` with ``_hot``, whether its group is one of ``hot``."""
    return df.join(hot.withColumn("_hot", F.lit(True)), list(by), "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def _blocked(df: DataFrame, block) -> tuple[DataFrame, list[str]]:
    blocks = block if isinstance(block, (list, tuple)) else [block]
    names = [f"_block{i}" for i in range(len(blocks))]
    return df.withColumns(dict(zip(names, blocks, strict=True))), names


def _only_hot(df: DataFrame, by, block, hot: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``df`` with ``_hot`` and its blocks; any other group is one block, whose number is null."""
    blocks = block if isinstance(block, (list, tuple)) else [block]
    return marked(df, by, hot), [F.when(F.col("_hot"), b) for b in blocks]


def _values(names) -> Column:
    return F.struct(*[F.col(v).alias(v) for v in names])


def neighbours(
    df, by, order, block, previous=(), following=(), circular=False,
    previous_prefix="previous_", next_prefix="next_", hot: DataFrame | None = None,
) -> DataFrame:
    """``lag`` of the ``previous`` and ``lead`` of the ``following`` columns, from one shuffle.

    Inside a block both are plain windows. The first and the last row of a block are its
    summary: they alone meet the other blocks' edges (two rows a block and group), while
    the rows between pass by. Both halves read the same exchange, so the source is
    scanned and shuffled once. ``circular`` joins the two ends of a group.

    With ``hot``, from ``hot_groups``, only those groups are cut; without any, one window does.
    """
    by, order = list(by), list(order)
    if hot is not None and not circular:
        if hot.isEmpty():
            whole = Window.partitionBy(*by).orderBy(*columns(order))
            near = {f"{previous_prefix}{v}": F.lag(v).over(whole) for v in previous}
            return df.withColumns(near | {f"{next_prefix}{v}": F.lead(v).over(whole) for v in following})
        df, block = _only_hot(df, by, block, hot)
    df, blocks = _blocked(df, block)
    df = df.drop("_hot")
    keys = by + blocks
    within = Window.partitionBy(*keys).orderBy(*columns(order))
    back, ahead = _values(previous or order[:1]), _values(following or order[:1])
    local = df.repartition(*columns(keys)).withColumns(
        {"_back": F.lag(back).over(within), "_ahead": F.lead(ahead).over(within)}
    )
    # A struct is null only where there is no such row.
    edge = F.col("_back").isNull() | F.col("_ahead").isNull()
    across = Window.partitionBy(*by).orderBy(*columns(blocks + order))
    before, after = F.lag(back).over(across), F.lead(ahead).over(across)
    if circular:
        everything = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = F.coalesce(before, F.last(back).over(everything))
        after = F.coalesce(after, F.first(ahead).over(everything))
    # Window columns first: they read the edges of all blocks, not those found so far.
    edges = local.where(edge).withColumns({"_before": before, "_after": after})
    edges = edges.withColumns(
        {"_back": F.coalesce("_back", "_before"), "_ahead": F.coalesce("_ahead", "_after")}
    ).drop("_before", "_after")
    both = local.where(~edge).unionByName(edges)
    near = {f"{previous_prefix}{v}": F.col("_back")[v] for v in previous}
    near |= {f"{next_prefix}{v}": F.col("_ahead")[v] for v in following}
    return both.withColumns(near).drop("_back", "_ahead", *blocks)


def previous_row(df, by, order, values, block, prefix="previous_", circular=False, hot: DataFrame | None = None) -> DataFrame:
    """``lag`` of ``values`` in each group; ``circular`` gives the first row the last one."""
    return neighbours(df, by, order, block, values, (), circular, previous_prefix=prefix, hot=hot)


def next_row(df, by, order, values, block, prefix="next_", circular=False) -> DataFrame:
    """``lead`` of ``values`` in each group; ``circular`` gives the last row the first one."""
    return neighbours(df, by, order, block, (), values, circular, next_prefix=prefix)


def _running(df, by, order, block, values: dict[str, Column], combine, join, start) -> DataFrame:
    """``combine`` of each value over the rows strictly before in the group; ``join`` puts two results together."""
    by = list(by)
    value = {name: f"_value{i}" for i, name in enumerate(values)}
    df, blocks = _blocked(df.withColumns({value[n]: v for n, v in values.items()}), block)
    keys = by + blocks
    before = Window.unboundedPreceding, -1
    across = Window.partitionBy(*by).orderBy(*columns(blocks)).rowsBetween(*before)
    sums = df.groupBy(*keys).agg(*[combine(v).alias(f"_sum{v}") for v in value.values()])
    sums = sums.select(*keys, *[start(combine(f"_sum{v}").over(across)).alias(f"_to{v}") for v in value.values()])
    within = Window.partitionBy(*keys).orderBy(*columns(order)).rowsBetween(*before)
    local = {n: start(combine(v).over(within)) for n, v in value.items()}
    out = df.withColumns(local).join(sums, keys)
    return out.withColumns({n: join(F.col(n), F.col(f"_to{v}")) for n, v in value.items()}).drop(
        *value.values(), *[f"_to{v}" for v in value.values()], *blocks
    )


def running_totals(df, by, order, block, totals: dict[str, Column]) -> DataFrame:
    """For each name the sum of its value over the rows strictly before in the group.

    All totals come from one window and one summary. The summary adds up blocks, combined
    before the shuffle: it reads the columns of keys and values only, so where the source
    is columnar its second read is a narrow one.
    """
    return _running(df, by, order, block, totals, F.sum, lambda a, b: a + b, lambda c: F.coalesce(c, F.lit(0)))


def running_maxima(df, by, order, block, values: dict[str, Column]) -> DataFrame:
    """The same with the largest value so far, null on the first row of a group."""
    return _running(df, by, order, block, values, F.max, F.greatest, lambda c: c)


def running_total(df, by, order, block, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over the rows strictly before each row of its group."""
    return running_totals(df, by, order, block, {name: value})


def runs(df, by, order, block, same, name: str, pieces_of, runs_of) -> DataFrame:
    """One row per maximal run of rows that agree on the ``same`` columns with the row before.

    Runs are first reduced to pieces inside their block, where the exchange of rows has put
    them: ``pieces_of(rows, keys, ends)`` aggregates by ``keys`` and keeps the ``ends``. Only
    the first and the last piece of a block may go on in another one. These (two a block)
    meet in their group and are numbered; pieces between stay apart. ``runs_of(pieces, keys)``
    then merges pieces. Rows are scanned and shuffled once. ``name`` tells the runs of a
    group apart; it is no running number.
    """
    df, blocks = _blocked(df, block)
    by, order = list(by), list(order)
    keys = by + blocks
    within = Window.partitionBy(*columns(keys)).orderBy(*columns(order))
    now = _values(same)
    changed = _starts(F.lag(now).over(within), now, same)
    rows = df.withColumn("_changed", changed)
    rows = rows.withColumn("_piece", F.sum("_changed").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct(*columns(order))
    ends = [F.min_by(now, place).alias("_begin"), F.max_by(now, place).alias("_end")]
    pieces = pieces_of(rows, [*keys, "_piece"], ends)
    edge = (F.col("_piece") == 1) | (F.col("_piece") == F.max("_piece").over(Window.partitionBy(*keys)))
    pieces = pieces.withColumn("_edge", edge)
    # Edges share one place in their group, an inner piece has its own.
    own = {f"_at{i}": F.when(~F.col("_edge"), F.col(b)) for i, b in enumerate([*blocks, "_piece"])}
    pieces = pieces.withColumns(own)
    together = Window.partitionBy(*by, *own).orderBy(*columns(blocks), "_piece")
    first = _starts(F.lag("_end").over(together), F.col("_begin"), same)
    # A block's later pieces begin with a change, whatever the edge piece before them holds.
    pieces = pieces.withColumn("_begins", F.when(F.col("_piece") != 1, 1).otherwise(first))
    number = F.sum("_begins").over(together.rowsBetween(Window.unboundedPreceding, 0))
    pieces = pieces.withColumn(name, F.struct(*own, number.alias("number")))
    return runs_of(pieces, [*by, name])


def _starts(before: Column, now: Column, names) -> Column:
    """1 where there is no row before or a value is known to differ from it; a null says nothing."""
    equal = reduce(lambda a, b: a & b, [F.coalesce(before[n] == now[n], F.lit(True)) for n in names])
    return F.when(before.isNull() | ~equal, 1).otherwise(0)


def row_numbers(df, by, order, block, name="row_number", start=1, hot: DataFrame | None = None) -> DataFrame:
    """``row_number`` within ``by``, for order columns that can be cut into blocks.

    With ``hot``, from ``hot_groups``, only those groups are cut, and the summary reads them
    alone; the others are numbered in one window.
    """
    if hot is not None:
        whole = Window.partitionBy(*by).orderBy(*columns(order))
        if hot.isEmpty():
            return df.withColumn(name, (F.row_number().over(whole) + F.lit(start - 1)).cast("long"))
        df, block = _only_hot(df, by, block, hot)
        df, blocks = _blocked(df, block)
        keys = [*by, *blocks]
        within = Window.partitionBy(*keys).orderBy(*columns(order))
        across = Window.partitionBy(*by).orderBy(*columns(blocks)).rowsBetween(Window.unboundedPreceding, -1)
        sums = df.where("_hot").groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        sums = sums.select(*keys, F.coalesce(F.sum("_rows").over(across), F.lit(0)).alias("_before"))
        out = df.withColumn(name, F.row_number().over(within)).join(sums, keys, "left")
        place = F.col(name) + F.coalesce("_before", F.lit(0)) + F.lit(start - 1)
        return out.withColumn(name, place.cast("long")).drop("_hot", "_before", *blocks)
    numbered = running_total(df, by, order, block, F.lit(1), name)
    return numbered.withColumn(name, (F.col(name) + F.lit(start)).cast("long"))


def first_rows(df, by, order, block, n: int) -> DataFrame:
    """The first ``n`` rows of each group in order, however large group and ``n`` are.

    Blocks are counted first, combined before the shuffle; a block that begins behind the
    n-th row is filtered where its rows are read, and the rows of the others are numbered
    block by block. No task holds more than a block, and rows that are not wanted stay.
    """
    df, blocks = _blocked(df, block)
    by = list(by)
    keys = by + blocks
    sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    across = Window.partitionBy(*by).orderBy(*columns(blocks)).rowsBetween(Window.unboundedPreceding, -1)
    wanted = sums.select(*keys, F.coalesce(F.sum("_rows").over(across), F.lit(0)).alias("_before")).where(F.col("_before") < n)
    within = Window.partitionBy(*keys).orderBy(*columns(order))
    kept = df.join(sized(wanted), keys).withColumn("_place", F.col("_before") + F.row_number().over(within))
    return kept.where(F.col("_place") <= n).drop("_place", "_before", *blocks)


def sorted_numbers(df, by, order, name="row_number", start=1) -> DataFrame:
    """``row_number`` within ``by`` for any order, text included.

    One range-partitioned sort, checkpointed so that positions stay fixed if an
    executor is lost; a summary with one row per (partition, group) shifts the
    local positions. ``order`` entries are names or ``Column`` sort keys.
    """
    by = list(by)
    keys = [*columns(by), *columns(order)]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = checkpointed(laid.withColumn("_at", F.monotonically_increasing_id()))
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    local = laid.groupBy("_part", *by).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    across = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    local = local.withColumn("_before", F.coalesce(F.sum("_rows").over(across), F.lit(0)))
    position = F.col("_at") - F.col("_first") + F.col("_before") + F.lit(start)
    return (
        laid.join(local, ["_part", *by])
        .withColumn(name, position.cast("long"))
        .drop("_at", "_part", "_first", "_rows", "_before")
    )


def lookahead(df, by, order, value, horizon: int, name: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Array of ``value`` on this and the next ``horizon - 1`` rows of the group.

    ``order`` is a contiguous integer. The first rows of a block are also sent to
    the block before it, so one shuffle serves all offsets.
    """
    home = index_block(order, rows)
    both = F.when(
        (F.col(order) % rows < horizon - 1) & (F.col(order) >= rows), F.array(home, home - 1)
    ).otherwise(F.array(home))
    spread = df.withColumn("_block", F.explode(both))
    ahead = (
        Window.partitionBy(*by, "_block").orderBy(order).rowsBetween(0, horizon - 1)
    )
    return (
        spread.withColumn(name, F.collect_list(value).over(ahead))
        .where(F.col("_block") == home)
        .drop("_block")
    )
