"""Episodic tables that Spark derives from the driver tables, and the same as SQL.

Every derivation uses all rows of its tables. ``WITH`` texts are for the SQL side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.contract import Layout
from episodica.functions.labels import numbered_name
from episodica.functions.vectors import joint_groups
from episodica.operators.ordered import hot_groups, index_block, row_numbers, spread

EVENT_KEYS = ["dataset", "split", "episode_index"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


def split_of(number: Column) -> Column:
    digit = F.pmod(number, F.lit(10))
    return F.when(digit == 8, "validation").when(digit == 9, "test").otherwise("train")


def split_sql(number: str) -> str:
    return f"CASE ({number}) % 10 WHEN 8 THEN 'validation' WHEN 9 THEN 'test' ELSE 'train' END"


# --- events: one episode per user, one frame per event ------------------------------

EVENTS = f"""
ev AS MATERIALIZED (
  SELECT 'events' AS dataset, {split_sql('user_id')} AS split, user_id AS episode_index,
    ts, event_id, event_type, value,
    CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index
  FROM events)
"""


def event_rows(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(
        F.lit("events").alias("dataset"),
        split_of(F.col("user_id")).alias("split"),
        F.col("user_id").alias("episode_index"),
        "ts",
        "event_id",
        "event_type",
        "value",
        F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("double").alias("k"),
    )


def time_block() -> Column:
    """One block per minute: a user of any size has few rows in each, and a summary
    has at most one row per minute of the recorded span."""
    return F.date_trunc("minute", F.col("ts"))


EVENT_ORDER = ["ts", "event_id"]


def event_frames(spark, d) -> DataFrame:
    rows = event_rows(spark, d)
    rows = spread(rows, EVENT_KEYS, table(spark, d, "events").count())
    return row_numbers(rows, EVENT_KEYS, EVENT_ORDER, time_block(), "frame_index", start=0, hot=hot_groups(event_rows(spark, d), EVENT_KEYS))


EVENT_EPISODES = """
ep AS MATERIALIZED (
  SELECT dataset, split, episode_index, count(*) AS length,
    CASE WHEN episode_index % 3 = 0 THEN 'pick' WHEN episode_index % 3 = 1 THEN 'place' ELSE 'stack' END AS task
  FROM ev GROUP BY ALL)
"""


def event_episodes(spark, d) -> DataFrame:
    third = F.pmod(F.col("episode_index"), F.lit(3))
    task = F.when(third == 0, "pick").when(third == 1, "place").otherwise("stack")
    sizes = event_rows(spark, d).groupBy(*EVENT_KEYS).agg(F.count(F.lit(1)).alias("length"))
    return sizes.withColumn("task", task)


# --- embeddings: 64-wide vectors, one episode per label -----------------------------

VECTORS = f"""
vec AS MATERIALIZED (
  SELECT 'vectors' AS dataset, {split_sql('label')} AS split, CAST(label AS BIGINT) AS episode_index,
    row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, vec_id,
    CAST(embedding AS DOUBLE[]) AS state, list_reverse(CAST(embedding AS DOUBLE[])) AS action
  FROM embeddings)
"""


def vector_rows(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    state = F.col("embedding").cast("array<double>")
    return e.select(
        F.lit("vectors").alias("dataset"),
        split_of(F.col("label")).alias("split"),
        F.col("label").cast("long").alias("episode_index"),
        "vec_id",
        state.alias("state"),
        F.reverse(state).alias("action"),
    )


def vector_frames(spark, d) -> DataFrame:
    return row_numbers(
        vector_rows(spark, d), EVENT_KEYS, ["vec_id"], index_block("vec_id"), "frame_index", start=0
    )


# --- conversations: three datasets with splits, one episode per conversation --------

TURNS = """
turns AS MATERIALIZED (
  SELECT ['base','left','right'][CAST(conv_id % 3 AS INT) + 1] AS dataset, conv_id % 3 AS source_rank,
    CASE (conv_id // 3) % 5 WHEN 3 THEN 'validation' WHEN 4 THEN 'test' ELSE 'train' END AS split,
    conv_id, turn AS frame_index, role, text,
    CAST(length(text) AS DOUBLE) AS size
  FROM conversations),
tasks AS MATERIALIZED (
  SELECT dataset, source_rank, split, role AS task,
    row_number() OVER (PARTITION BY dataset, split ORDER BY role) - 1 AS task_index
  FROM (SELECT DISTINCT dataset, source_rank, split, role FROM turns)),
eps AS MATERIALIZED (
  SELECT dataset, source_rank, split, conv_id, count(*) AS length,
    row_number() OVER (PARTITION BY dataset, split ORDER BY conv_id) - 1 AS episode_index
  FROM turns GROUP BY dataset, source_rank, split, conv_id),
frames AS (
  SELECT t.dataset, t.source_rank, t.split, e.episode_index, t.frame_index, k.task_index, t.role, t.size, t.conv_id
  FROM turns t JOIN eps e USING (dataset, source_rank, split, conv_id)
  JOIN tasks k ON k.dataset = t.dataset AND k.split = t.split AND k.task = t.role)
"""


def turn_rows(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    third = F.pmod(F.col("conv_id"), F.lit(3)).cast("int")
    fifth = F.pmod(F.expr("conv_id div 3"), F.lit(5))
    return c.select(
        F.get(F.array(F.lit("base"), F.lit("left"), F.lit("right")), third).alias("dataset"),
        third.alias("source_rank"),
        F.when(fifth == 3, "validation").when(fifth == 4, "test").otherwise("train").alias("split"),
        "conv_id",
        F.col("turn").alias("frame_index"),
        "role",
        "text",
        F.length("text").cast("double").alias("size"),
    )


def turn_tasks(spark, d) -> DataFrame:
    roles = turn_rows(spark, d).groupBy("dataset", "source_rank", "split", F.col("role").alias("task")).agg(
        F.lit(1).alias("_one")
    )
    # One row per distinct text of a split, numbered in a small window.
    order = Window.partitionBy("dataset", "split").orderBy("task")
    return roles.select(
        "dataset", "source_rank", "split", "task", (F.row_number().over(order) - 1).cast("long").alias("task_index")
    )


def turn_episodes(spark, d) -> DataFrame:
    keys = ["dataset", "source_rank", "split", "conv_id"]
    sizes = turn_rows(spark, d).groupBy(*keys).agg(F.count(F.lit(1)).alias("length"))
    return row_numbers(
        sizes, ["dataset", "source_rank", "split"], ["conv_id"], index_block("conv_id"), "episode_index", start=0
    )


def turn_frames(spark, d, episodes: DataFrame | None = None, tasks: DataFrame | None = None) -> DataFrame:
    keys = ["dataset", "source_rank", "split"]
    rows = turn_rows(spark, d).drop("text")
    episodes = turn_episodes(spark, d) if episodes is None else episodes
    rows = rows.join(episodes.drop("length"), [*keys, "conv_id"])
    tasks = (turn_tasks(spark, d) if tasks is None else tasks).withColumnRenamed("task", "role")
    return rows.join(tasks, [*keys, "role"])


# --- documents: one episode per document ---------------------------------------------

DOCS = f"""
docs AS MATERIALIZED (
  SELECT source AS source_dataset, source AS source_session, lang AS goal, doc_id AS episode_index,
    printf('episode_%06d', doc_id) AS source_episode, source || '/' || printf('episode_%06d', doc_id) AS source_identity,
    n_chars AS frame_count, sha256(text) AS data_json_sha256, {split_sql('doc_id')} AS split, doc_id
  FROM documents)
"""


def doc_episodes(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    name = numbered_name(F.col("doc_id"), 6)
    return docs.select(
        F.col("source").alias("source_dataset"),
        F.col("source").alias("source_session"),
        F.col("lang").alias("goal"),
        F.col("doc_id").alias("episode_index"),
        name.alias("source_episode"),
        F.concat_ws("/", "source", name).alias("source_identity"),
        F.col("n_chars").alias("frame_count"),
        F.sha2("text", 256).alias("data_json_sha256"),
        split_of(F.col("doc_id")).alias("split"),
        "doc_id",
    )


# --- line items: predictions against recorded values ---------------------------------

LAYOUT: Layout = [("left_arm", 0, 2), ("right_arm", 2, 4), ("left_hand", 4, 5), ("right_hand", 5, 7)]

PAIRS = """
pairs AS MATERIALIZED (
  SELECT l_orderkey AS episode_index, o_orderpriority AS task, o_orderstatus AS cohort,
    CASE l_returnflag WHEN 'N' THEN 'train' WHEN 'A' THEN 'validation' ELSE 'test' END AS part,
    l_linenumber - 1 AS joint_index, l_suppkey % 2 AS shuffle_repeat,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS frame_index,
    l_extendedprice / 99991.0 AS expert,
    l_quantity * p_retailprice / 99991.0 AS intact,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) / 99991.0 AS counterfactual
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)
"""

GROUPED = """
grouped AS (
  SELECT p.*, g.grp AS "group" FROM pairs p
  JOIN (VALUES ('all',0,7),('left_arm',0,2),('right_arm',2,4),('left_hand',4,5),('right_hand',5,7),
               ('arms',0,4),('hands',4,7),('left_side',0,2),('left_side',4,5),('right_side',2,4),('right_side',5,7)
  ) AS g(grp, lo, hi) ON p.joint_index >= g.lo AND p.joint_index < g.hi)
"""


def pair_rows(spark, d) -> DataFrame:
    """Predictions, dealt by episode: the orders are joined last, so what follows by episode needs no shuffle."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus"
    )
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    n = table(spark, d, "lineitem").count()
    rows = spread(spread(rows, ["l_partkey"], n).join(parts, "l_partkey"), ["l_orderkey"], n)
    return rows.join(orders, "l_orderkey").select(
        F.col("l_orderkey").alias("episode_index"),
        F.col("o_orderpriority").alias("task"),
        F.col("o_orderstatus").alias("cohort"),
        F.when(F.col("l_returnflag") == "N", "train")
        .when(F.col("l_returnflag") == "A", "validation")
        .otherwise("test")
        .alias("part"),
        (F.col("l_linenumber") - 1).alias("joint_index"),
        F.pmod("l_suppkey", F.lit(2)).alias("shuffle_repeat"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        (F.col("l_extendedprice") / 99991.0).alias("expert"),
        (F.col("l_quantity") * F.col("p_retailprice") / 99991.0).alias("intact"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 99991.0).alias("counterfactual"),
    )


PAIR_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def plain_pairs(spark, d) -> DataFrame:
    """Predictions without frame numbers."""
    return pair_rows(spark, d).drop(*PAIR_ORDER)


def hot_pairs(spark, d) -> DataFrame:
    """Episodes of predictions with very many rows; an order's lines are counted before the joins."""
    return hot_groups(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("episode_index")), ["episode_index"])


def pairs(spark, d, hot: DataFrame | None = None) -> DataFrame:
    """Predictions with their frame number inside the order; ``hot`` from ``hot_pairs``, if it is at hand."""
    block = [F.col("l_linenumber"), index_block("l_partkey")]
    hot = hot_pairs(spark, d) if hot is None else hot
    rows = row_numbers(pair_rows(spark, d), ["episode_index"], PAIR_ORDER, block, "frame_index", start=0, hot=hot)
    return rows.drop(*PAIR_ORDER)


def groups() -> Column:
    return joint_groups(F.col("joint_index"), LAYOUT)


def grouped(df: DataFrame) -> DataFrame:
    return df.withColumn("group", F.explode(groups()))


# --- checkpoint metrics: one model per brand, one step per line number ---------------

METRICS = """
metrics AS (
  SELECT p_brand AS model,
    CASE l_returnflag WHEN 'N' THEN 'train' WHEN 'A' THEN 'validation' ELSE 'test' END AS split,
    CAST(l_linenumber * 5000 AS BIGINT) AS checkpoint_step, count(DISTINCT l_orderkey) AS episodes,
    count(*) AS frames, CAST(min(l_extendedprice) AS DECIMAL(38,18)) AS mae,
    CAST(min(l_quantity) AS DECIMAL(38,18)) AS mse, CAST(26 AS BIGINT) AS dimensions, count(*) * 26 AS samples
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
"""


def metrics(spark, d) -> DataFrame:
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_quantity"
    )
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    split = F.when(F.col("l_returnflag") == "N", "train").when(F.col("l_returnflag") == "A", "validation")
    rows = lines.join(parts, "l_partkey").select(
        F.col("p_brand").alias("model"),
        split.otherwise("test").alias("split"),
        (F.col("l_linenumber") * 5000).cast("long").alias("checkpoint_step"),
        "l_orderkey", "l_extendedprice", "l_quantity",
    )
    keys = ["model", "split", "checkpoint_step"]
    per_order = rows.groupBy(*keys, "l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("a"), F.min("l_quantity").alias("s")
    )
    return per_order.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("episodes"),
        F.sum("n").alias("frames"),
        F.min("a").cast("decimal(38,18)").alias("mae"),
        F.min("s").cast("decimal(38,18)").alias("mse"),
        F.lit(26).cast("long").alias("dimensions"),
        (F.sum("n") * 26).alias("samples"),
    )


STATUS = """
status AS (
  SELECT m.stage, p_brand AS model,
    CASE WHEN sum(p_size) % 7 = 0 AND m.stage = 'evaluation' THEN 'FAIL' ELSE 'PASS' END AS status,
    CASE WHEN sum(p_size) % 7 = 0 AND m.stage = 'evaluation' THEN 1 ELSE 0 END AS exit_code
  FROM part CROSS JOIN (VALUES ('training'), ('evaluation')) AS m(stage) GROUP BY m.stage, p_brand)
"""


def status(spark, d) -> DataFrame:
    models = table(spark, d, "part").groupBy(F.col("p_brand").alias("model")).agg(F.sum("p_size").alias("n"))
    rows = models.withColumn("stage", F.explode(F.array(F.lit("training"), F.lit("evaluation"))))
    failed = (F.col("n") % 7 == 0) & (F.col("stage") == "evaluation")
    return rows.select(
        "stage", "model", F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        F.when(failed, 1).otherwise(0).alias("exit_code"),
    )


def union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
