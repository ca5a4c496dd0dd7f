"""Mixing sources to target weights with built-in functions only.

Targets are the weights' shares of all words, capped at ``MOST`` times a source's own
words; the excess is shared again by weight. Words are dealt out in blocks of equal length:
every source gets a whole number of blocks by highest quotients t / (2k + 1), every shard of
a source again by its size, and within a shard a seeded choice takes its quota of blocks,
none more than ``MOST`` times.

Defined results: a null text has no words; a null source is a source of its own, after all
others; empty documents take part with nothing taken; rows may repeat, each is taken by
itself; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.llm.tables import keyed, written

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 32
SHARD_ROWS = 2048
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
# A prime above any number of blocks in a shard: b -> b * STRIDE + shift runs through all of them.
STRIDE = 2_147_483_647


def draw(*parts) -> Column:
    """A seeded 60-bit number of the parts, the same in every run."""
    key = F.concat_ws(":", F.lit(SEED), *(F.coalesce(F.col(p).cast("string"), F.lit("~")) for p in parts))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def capped_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to a table with ``weight`` and ``source_size``, a row per source.

    A target is the smaller of most * source_size and level * weight; sources below their
    cap share what the capped ones leave. One running sum in order of cap / weight finds
    the level.
    """
    cap = F.col("source_size") * most
    order = Window.orderBy(cap / F.col("weight"), "source_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = F.when(cap * open_weight >= left * F.col("weight"), left / open_weight)
    return (
        sources.withColumn("level", level)
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least(cap.cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")))
        .drop("level")
    )


def highest_quotients(shares: DataFrame, group: list[str], share: str, seats: Column, tie: list[str], out: str) -> DataFrame:
    """Sainte-Lague: ``seats`` go one by one to the highest share / (2k + 1) of the group.

    A divisor that surely gives too few and one that surely gives enough leave about two
    open seats per row; only those are ranked.
    """
    all_rows = Window.partitionBy(*group)
    named = shares.withColumn("_seats", seats).withColumn("_n", F.count("*").over(all_rows)).withColumn("_all", F.sum(share).over(all_rows))
    few = F.greatest(F.floor(F.col(share) * (F.col("_seats") - F.col("_n") / 2) / F.col("_all") + 0.5), F.lit(0))
    enough = F.floor(F.col(share) * (F.col("_seats") + F.col("_n") / 2 + 1) / F.col("_all") + 0.5)
    named = named.withColumn("_few", F.when(F.col("_all") > 0, few).otherwise(0).cast("long"))
    named = named.withColumn("_enough", F.when(F.col("_all") > 0, enough).otherwise(0).cast("long"))
    named = named.withColumn("_open", F.col("_seats") - F.sum("_few").over(all_rows))
    # The row's own certain seats appear as seat null, so that every row stays.
    seat = F.explode(F.concat(F.array(F.lit(None).cast("long")), F.when(F.col("_enough") > F.col("_few"), F.sequence("_few", F.col("_enough") - 1)).otherwise(F.array().cast("array<bigint>"))))
    opened = named.withColumn("_seat", seat)
    ranked = Window.partitionBy(*group).orderBy(F.col("_quotient").desc_nulls_last(), *tie, "_seat")
    opened = opened.withColumn("_quotient", F.col(share) / (2 * F.col("_seat") + 1)).withColumn("_place", F.row_number().over(ranked))
    won = F.sum(((F.col("_seat").isNotNull()) & (F.col("_place") <= F.col("_open"))).cast("long"))
    kept = [c for c in shares.columns]
    return opened.groupBy(*kept, "_few").agg(won.alias("_won")).withColumn(out, F.col("_few") + F.col("_won")).drop("_few", "_won")


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights=WEIGHTS, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Each row's size, source_size, target and taken words (repeats counted)."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), words_in(F.col(text_column)).alias("size"))
    cut = dealt(rows.withColumn("spot", draw("id")), weights, block, shard_rows)
    return cut.select("id", "source", "size", "source_size", "target", "taken")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def dealt(rows: DataFrame, weights=WEIGHTS, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``taken`` and the shard of rows with id, source, size and ``spot``, the draw that orders them."""
    rows = written(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.ceil(F.count("*") / shard_rows).alias("shards"))
    # A row per source: the ordering of the source names is one small window by definition.
    ranked = sources.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*(F.lit(w) for w in weights))
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.pmod("source_rank", F.lit(len(weights))) + 1).cast("int")))
    targets = capped_targets(ranked)
    seats = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    quotas = written(highest_quotients(targets, [], "target", seats, ["source_rank"], "source_quota"), "source-quotas")

    placed = rows.join(quotas.select("source", "shards", "source_size", "target", "source_quota", "source_rank"), rows["source"].eqNullSafe(quotas["source"])).drop(quotas["source"])
    placed = placed.withColumn("shard", F.pmod(F.col("spot"), F.col("shards")))
    shards = placed.groupBy("source_rank", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    shares = highest_quotients(shards, ["source_rank"], "shard_size", F.col("source_quota"), ["shard"], "quota")
    shares = shares.withColumn("blocks", F.greatest(F.round(F.col("shard_size") / block).cast("long"), F.lit(1))).withColumn("shift", draw("source_rank", "shard"))

    order = Window.partitionBy("source_rank", "shard").orderBy("spot", "id", "size")
    begin = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    cut = placed.withColumn("begin", begin).join(shares.select("source_rank", "shard", "shard_size", "quota", "blocks", "shift"), ["source_rank", "shard"])

    first = F.expr("((begin + 1) * blocks - 1) div shard_size")
    last = F.expr("((begin + size) * blocks - 1) div shard_size")
    # Times that block b is taken: quota div blocks, and once more for the seeded remainder.
    times = f"least({MOST}, quota div blocks + CASE WHEN pmod(pmod(b, blocks) * {STRIDE} + shift % blocks, blocks) < quota % blocks THEN 1 ELSE 0 END)"
    words = "least(begin + size, (b + 1) * shard_size div blocks) - greatest(begin, b * shard_size div blocks)"
    taken = F.expr(f"CASE WHEN size > 0 THEN aggregate(sequence(first_block, last_block), 0L, (a, b) -> a + ({words}) * ({times})) ELSE 0L END")
    return (
        cut.withColumn("first_block", F.when(F.col("size") > 0, first).otherwise(0))
        .withColumn("last_block", F.when(F.col("size") > 0, last).otherwise(0))
        .select("id", "source", "size", "source_size", "target", "source_rank", "shard", "spot", taken.alias("taken"))
    )


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings) -> DataFrame:
    """The mix as whole documents: each row as often as its taken words fill it.

    What is left of a row is rounded up or down by a seeded draw in proportion, so that sources
    keep their words on average; rows without words are not taken. Draws are made from the
    identifier and the content of a row, and its number among fully equal rows; file and row
    only find it again. So two runs on the same rows give the same rows.
    """
    rows = keyed(docs, id_column)
    flat = rows.select(F.col("key").alias("id"), F.col(f"row.`{source_column}`").alias("source"), words_in(F.col(f"row.`{text_column}`")).alias("size"))
    equal = Window.partitionBy("id.id", "id.content").orderBy("id.file", "id.row")
    flat = flat.withColumn("copy", F.row_number().over(equal)).withColumn("spot", draw("id.id", "id.content", "copy")).drop("copy")
    taken = dealt(flat, **settings).withColumn("part", F.conv(F.substring(F.md5(F.concat(F.lit("round:"), F.col("spot").cast("string"))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52)))
    times = taken.filter("size > 0").select(F.col("id.file").alias("_file"), F.col("id.row").alias("_row"), F.floor(F.col("taken") / F.col("size") + F.col("part")).cast("int").alias("_times")).filter("_times > 0")
    found = rows.join(times, (F.col("key.file") == F.col("_file")) & (F.col("key.row") == F.col("_row")))
    return found.select("row", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select("row.*")
