"""Bootstrap intervals over episodes.

Replicates are drawn by hash, so an interval depends on the seed and the data only.
Draws go in two stages with the same distribution as one. Episodes are numbered and cut into
blocks; first every slot of a replicate draws the block of its episode, and only the
counts per (group, replicate, block) leave the task, those of neighbouring blocks as one
array. Then, inside the one row that holds the values of some blocks, that many local draws are
made. No slot is a row, and a group that fits one block needs no first stage. The work is cut by
its number of draws, into tasks long enough that the driver has few of them to keep.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from episodica.functions import digests
from episodica.functions.seeds import digest_text
from episodica.operators.ordered import row_numbers
from episodica.operators.quantiles import exact_quantiles, match
from episodica.shared import BROADCAST_ROWS, checkpointed, stored

INTERVAL = {"ci95_low": 0.025, "ci95_high": 0.975}


BLOCK = 1024
"""Episodes that are drawn together in the second stage."""
SPAN = 16
"""Blocks in one row at most."""
PART = 500
"""Replicates that one row draws for its blocks at once."""
UNIT, LONG = 1 << 22, 1 << 24
"""Draws of a row of the first stage: of several replicates together, and of one at most."""
TASK = 1 << 27
"""Draws of a task, under half a minute. A shuffle has a size per pair of tasks and the driver a
record per task, so tasks are no shorter where there are many draws."""


def _block_counts(batches):
    """First stage: how often each block is drawn by the replicates of a row, blocks of a span together."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            first, last, size = row["_first"], row["_last"], row["_size"]
            blocks = -(-size // BLOCK)
            found = np.zeros((last - first, -(-blocks // SPAN) * SPAN), np.int64)
            ends = np.full(last - first, row["_end"])
            for at, count, high, low in digests.digests(row["_text"], (first, last), "", row["_start"], ends):
                place = digests.below(high, low, size) // BLOCK
                if len(count) > 1:
                    place += np.repeat(np.arange(len(count)) * found.shape[1], count)
                some = found[at : at + len(count)]
                some += np.bincount(place, minlength=some.size).reshape(some.shape)
            spans = found.shape[1] // SPAN
            # One array per span: the counts of its blocks, replicate after replicate.
            values = pa.array(found.reshape(last - first, spans, SPAN).transpose(1, 0, 2).ravel(), pa.int32())
            counts = pa.ListArray.from_arrays(pa.array(np.arange(spans + 1) * (last - first) * SPAN, pa.int32()), values)
            same = [pa.array(np.full(spans, row[n])) for n in ("_group", "_from", "_first")]
            out.append(pa.record_batch([*same, pa.array(np.arange(spans)), counts], names=["_group", "_from", "_first", "_span", "_k"]))
        yield from out


COUNTS = "_group long, _from long, _first long, _span long, _k array<int>"


def _span_sums(keys, replicates: int):
    """Second stage: sums of the values that the replicates of a row draw from its blocks."""

    def run(batches):
        for batch in batches:
            parts = []
            for i in range(batch.num_rows):
                of = lambda name: batch.column(name)[i].as_py()  # noqa: E731, B023
                first = of("_from")
                last = min(first + PART, replicates)
                drawn = np.full((last - first, SPAN), of("_size") if of("_size") <= BLOCK else 0)
                some = batch.column("_counts")[i]
                if some.is_valid:
                    starts, counts = [some.values.field(n) for n in ("_first", "_k")]
                    for at, k in zip(starts.to_pylist(), counts, strict=True):
                        k = k.values.to_numpy().reshape(-1, SPAN)
                        drawn[at - first : at - first + len(k)] += k
                # Both sums of an episode are one number, its two parts.
                both = [batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in ("_s", "_n")]
                pairs = np.empty(len(both[0]), np.complex128)
                pairs.real, pairs.imag = both
                total = np.zeros(last - first, np.complex128)
                for block in range(-(-len(pairs) // BLOCK)):
                    mine = pairs[block * BLOCK : (block + 1) * BLOCK]
                    number = str(of("_span") * SPAN + block)
                    for at, count, high, low in digests.digests(of("_slot"), (first, last), f"{len(number)}:{number}", 0, drawn[:, block]):
                        values, some = mine[digests.below(high, low, len(mine))], np.flatnonzero(count)
                        total[at + some] += np.add.reduceat(values, (np.cumsum(count) - count)[some])
                same = batch.select(keys).take(pa.array(np.full(last - first, i)))
                sums = [pa.array(np.arange(first, last)), pa.array(total.real.copy()), pa.array(total.imag.copy())]
                parts.append(pa.record_batch([*same.columns, *sums], names=[*keys, "replicate", "_s", "_n"]))
            yield from parts

    return run


def _replicate_sums(clusters: DataFrame, keys, block, replicates: int, seed: int) -> DataFrame:
    """``keys, replicate`` and the drawn sums of ``_s`` and ``_n``, as many draws as clusters.

    For their quotient only: where all ``_s`` of a group are 0 and no ``_n`` is, nothing is drawn
    and ``_n`` is 1, as the quotient is 0 whatever is drawn.
    """
    keys = list(keys)
    zero = F.min(F.coalesce((F.col("_s") == 0) & (F.col("_n") > 0), F.lit(False)))
    sizes = clusters.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), zero.alias("_zero"))
    # Null keys are groups too: one number stands for all keys.
    sizes = checkpointed(sizes.withColumn("_group", F.monotonically_increasing_id()))
    # Only joins with the sizes ask for a broadcast. Spark carries that wish on to all that is derived
    # from one table alone, and the counts are: they must not be sent to the driver.
    joined = F.broadcast if sizes.count() <= BROADCAST_ROWS else lambda df: df
    plain = sizes.where("_zero").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(replicates - 1).cast("long"))).alias("replicate"))
    plain = plain.select("*", F.lit(0.0).alias("_s"), F.lit(1.0).alias("_n"))
    sizes = sizes.where("not _zero").drop("_zero")
    # Few rows stand for many draws, so tasks are counted by draws.
    draws = replicates * (sizes.agg(F.sum("_size")).first()[0] or 0)
    cores = clusters.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(draws // TASK + 1, 100_000), min(draws // UNIT + 1, 4 * cores))

    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(replicates - 1).cast("long"), F.lit(PART).cast("long")))
    units = sizes.where(F.col("_size") > BLOCK).withColumns(
        {"_text": digest_text(F.lit(str(seed)), *keys), "_step": F.greatest(F.lit(1).cast("long"), F.least(F.lit(PART).cast("long"), F.expr(f"{UNIT} div _size")))}
    )
    units = units.drop(*keys).withColumn("_from", spread)
    units = units.withColumn("_to", F.least(F.col("_from") + PART, F.lit(replicates)))
    units = units.withColumn("_first", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1, F.col("_step"))))
    units = units.withColumn("_last", F.least(F.col("_first") + F.col("_step"), F.col("_to")))
    units = units.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_size") - 1, F.lit(LONG).cast("long"))))
    units = units.withColumn("_end", F.least(F.col("_start") + LONG, F.col("_size"))).drop("_to", "_step")
    counts = units.repartition(tasks, "_group", "_first", "_start").mapInArrow(_block_counts, COUNTS)
    place = ["_group", "_span", "_from"]
    counts = counts.repartition(tasks, *place).groupBy(*place).agg(F.collect_list(F.struct("_first", "_k")).alias("_counts"))

    numbered = match(clusters, joined(sizes), keys).select("_group", "episode_index", "_s", "_n")
    numbered = row_numbers(numbered, ["_group"], ["episode_index"], block, "_number", start=0)
    value = F.struct("_number", *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in ("_s", "_n")])
    spans = numbered.groupBy("_group", F.expr(f"_number div {BLOCK * SPAN}").alias("_span")).agg(F.array_sort(F.collect_list(value)).alias("_rows"))
    slot = digest_text(F.lit(str(seed)), F.lit("slot"), *keys).alias("_slot")
    parts = spans.join(joined(sizes.select(*keys, "_group", "_size", slot)), "_group")
    parts = parts.select(*keys, "_group", "_size", "_span", "_slot", "_rows._s", "_rows._n").withColumn("_from", spread)
    parts = parts.repartition(tasks, *place).join(counts.hint("merge"), place, "left")
    own = [StructField("replicate", LongType()), StructField("_s", DoubleType()), StructField("_n", DoubleType())]
    sums = parts.mapInArrow(_span_sums(keys, replicates), StructType([*[clusters.schema[k] for k in keys], *own]))
    sums = sums.groupBy(*keys, "replicate").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    # Groups times replicates, read twice for the quantiles: never drawn twice.
    return checkpointed(sums.unionByName(plain))


def stratified_bootstrap_ci(
    effects: DataFrame, value: str, block, replicates: int, seed: int, keys=(), task="task"
) -> DataFrame:
    """Episodes are drawn with replacement in each task; the mean of task means.

    Several rows of an episode (repeats) are averaged first. Tasks weigh equally.
    """
    keys = list(keys)
    mean = F.avg(value)
    episodes = effects.groupBy(*keys, task, "episode_index").agg(mean.alias("_s"), mean.isNotNull().cast("long").alias("_n"))
    sums = _replicate_sums(stored(episodes, "episodes"), [*keys, task], block, replicates, seed)
    samples = sums.groupBy(*keys, "replicate").agg(F.avg(F.try_divide("_s", "_n")).alias("_m"))
    return exact_quantiles(samples, keys, "_m", INTERVAL)


def cluster_bootstrap_ci(
    rows: DataFrame, value: str, block, replicates: int, seed: int, keys=()
) -> DataFrame:
    """Whole episodes are drawn; the mean of all their rows, so long ones weigh more."""
    keys = list(keys)
    episodes = rows.groupBy(*keys, "episode_index").agg(
        F.sum(value).alias("_s"), F.count(value).alias("_n")
    )
    return cluster_interval(stored(episodes, "episodes"), block, replicates, seed, keys)


def cluster_interval(episodes: DataFrame, block, replicates: int, seed: int, keys=()) -> DataFrame:
    """A16 from one row per episode with the sum ``_s`` and the count ``_n`` of its values, read several times."""
    keys = list(keys)
    sums = _replicate_sums(episodes, keys, block, replicates, seed)
    samples = sums.select(*keys, "replicate", F.try_divide("_s", "_n").alias("_m"))
    return exact_quantiles(samples, keys, "_m", INTERVAL)
