"""Statistics and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.catalog.base import (
    EVENT_EPISODES, EVENT_KEYS, EVENT_ORDER, EVENTS, LAYOUT, TURNS, VECTORS, DOCS, time_block, doc_episodes,
    event_episodes, event_frames, event_rows, table, turn_episodes, turn_frames, turn_tasks,
    vector_frames, vector_rows, with_,
)
from episodica.catalog.registry import query
from episodica.functions.vectors import (
    check_vector, explode_joints, joint_groups, joint_name_faults, joint_names, slice_modality, stack_groups,
)
from episodica.operators import statistics as st
from episodica.plans.joint_report import joint_report

BASIC = """count(v) AS sample_count, count(v) FILTER (isfinite(v)) AS finite_count,
  count(v) FILTER (NOT isfinite(v)) AS nonfinite_count,
  min(v) AS min, max(v) AS max, avg(v) AS mean, stddev_pop(v) AS std, avg(abs(v)) AS abs_mean, max(abs(v)) AS abs_max,
  quantile_cont(v, 0.01) AS p01, quantile_cont(v, 0.05) AS p05, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.95) AS p95, quantile_cont(v, 0.99) AS p99,
  quantile_cont(abs(v), 0.95) AS abs_p95, quantile_cont(abs(v), 0.99) AS abs_p99"""
BASIC_DOUBLES = "min max mean std abs_mean abs_max p01 p05 median p95 p99 abs_p95 abs_p99"
BASIC_INTS = "sample_count finite_count nonfinite_count"
DELTA = """count(x) AS delta_sample_count, count(x) AS delta_finite_count, 0 AS delta_nonfinite_count,
  avg(abs(x)) AS abs_delta_mean, max(abs(x)) AS abs_delta_max,
  quantile_cont(abs(x), 0.95) AS abs_delta_p95, quantile_cont(abs(x), 0.99) AS abs_delta_p99"""
DELTA_DOUBLES = "abs_delta_mean abs_delta_max abs_delta_p95 abs_delta_p99"
DELTA_INTS = "delta_sample_count delta_finite_count delta_nonfinite_count"
SPEED = """,
  avg(abs(x)) * 30 AS abs_velocity_mean_rad_s, quantile_cont(abs(x), 0.95) * 30 AS abs_velocity_p95_rad_s,
  quantile_cont(abs(x), 0.99) * 30 AS abs_velocity_p99_rad_s, max(abs(x)) * 30 AS abs_velocity_max_rad_s"""
SPEED_DOUBLES = " ".join(f"abs_velocity_{k}_rad_s" for k in ("mean", "p95", "p99", "max"))

EVENT_STEPS = EVENTS + """,
steps AS (SELECT *, value - lag(value) OVER w AS x, value - lead(k) OVER w AS gap
  FROM ev WINDOW w AS (PARTITION BY dataset, split, episode_index ORDER BY ts, event_id))"""

VEC_LONG = VECTORS + """,
long AS (SELECT dataset, split, episode_index, frame_index, CAST(j AS INT) AS joint_index,
    state[j + 1] AS state, action[j + 1] AS action
  FROM vec, range(64) AS r(j))"""


@query(
    "A1_joint_statistics",
    f"{with_(VEC_LONG)} SELECT joint_index, 'joint_' || joint_index AS joint_name, {BASIC} "
    "FROM (SELECT *, state AS v FROM long) GROUP BY joint_index",
    BASIC_DOUBLES, BASIC_INTS + " joint_index",
)
def joint_statistics(spark, d):
    rows = explode_joints(vector_rows(spark, d).select("state"), "state")
    return st.joint_statistics(rows, ["joint_index", "joint_name"])


@query(
    "A1_value_statistics_by_event_type",
    f"{with_(EVENTS)} SELECT event_type, {BASIC} FROM (SELECT *, value AS v FROM ev) GROUP BY event_type",
    BASIC_DOUBLES, BASIC_INTS,
)
def value_statistics(spark, d):
    return st.joint_statistics(event_rows(spark, d), ["event_type"])


@query("S1_scan_frames", "SELECT user_id, ts, event_id, value FROM events", "value", "user_id event_id")
def scan(spark, d):
    from episodica.sources.scans import scan_frames

    return scan_frames(spark, f"{d}/events.parquet", ["user_id", "ts", "event_id", "value"])


@query(
    "P1_check_vector",
    """SELECT 'vector:embedding' AS "check", vec_id, CASE WHEN embedding IS NULL THEN 'null vector'
       WHEN len(embedding) <> 64 THEN 'width ' || len(embedding) ELSE 'null member' END AS detail
       FROM embeddings WHERE embedding IS NULL OR len(embedding) <> 64
       OR len(list_filter(embedding, lambda x: x IS NULL)) > 0""",
    ints="vec_id",
)
def vector_faults(spark, d):
    return check_vector(table(spark, d, "embeddings"), "embedding", 64, ["vec_id"])


@query(
    "P2_joint_names",
    f"""{with_(DOCS)}, named AS (SELECT source_dataset AS dataset, goal AS feature,
          [source_dataset || '_' || goal, goal] AS names, CASE WHEN min(doc_id) % 7 = 0 THEN 3 ELSE 2 END AS width
        FROM docs GROUP BY ALL)
        SELECT dataset, feature, 'names do not match width' AS detail FROM named WHERE width <> 2
        UNION ALL SELECT NULL, feature, 'order differs between datasets' FROM named
        GROUP BY feature HAVING count(DISTINCT names) > 1""",
)
def names(spark, d):
    rows = doc_episodes(spark, d).groupBy(F.col("source_dataset").alias("dataset"), F.col("goal").alias("feature"))
    width = F.when(F.min("doc_id") % 7 == 0, 3).otherwise(2)
    rows = rows.agg(width.alias("width"))
    text = F.format_string('[["%s_%s", "%s"]]', "dataset", "feature", "feature")
    return joint_name_faults(rows.withColumn("names", joint_names(text)))


@query(
    "P3_explode_joints",
    f"{with_(VEC_LONG)} SELECT dataset, episode_index, frame_index, joint_index, 'joint_' || joint_index AS joint_name, state AS value FROM long",
    "value", "episode_index frame_index joint_index",
)
def exploded(spark, d):
    rows = vector_frames(spark, d).select("dataset", "episode_index", "frame_index", "state")
    return explode_joints(rows, "state")


@query(
    "P4_stack_groups",
    f"""{with_(VECTORS)} SELECT vec_id, len(list_concat(state, action)) AS width,
        list_sum(list_concat(state, action)) AS total FROM vec""",
    "total", "vec_id width",
)
def stacked(spark, d):
    both = stack_groups(F.col("state"), F.col("action"))
    rows = vector_rows(spark, d).select("vec_id", both.alias("v"))
    return rows.select("vec_id", F.size("v").alias("width"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query(
    "P5_slice_modality",
    f"""{with_(VECTORS)} SELECT vec_id, list_sum(state[1:2]) AS left_arm, list_sum(state[3:4]) AS right_arm,
        list_sum(state[5:5]) AS left_hand, list_sum(state[6:7]) AS right_hand FROM vec""",
    "left_arm right_arm left_hand right_hand", "vec_id",
)
def sliced(spark, d):
    parts = slice_modality(F.col("state"), LAYOUT)
    return vector_rows(spark, d).select(
        "vec_id", *[F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias(k) for k, v in parts.items()]
    )


@query(
    "P6_joint_groups",
    """SELECT g.grp AS "group", count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem
       JOIN (VALUES ('all',1,7),('left_arm',1,2),('right_arm',3,4),('left_hand',5,5),('right_hand',6,7),
         ('arms',1,4),('hands',5,7),('left_side',1,2),('left_side',5,5),('right_side',3,4),('right_side',6,7)) AS g(grp, lo, hi)
       ON l_linenumber BETWEEN g.lo AND g.hi GROUP BY 1""",
    "quantity", "rows",
)
def groups(spark, d):
    lines = table(spark, d, "lineitem").select("l_linenumber", "l_quantity")
    fanned = lines.withColumn("group", F.explode(joint_groups(F.col("l_linenumber") - 1, LAYOUT)))
    return fanned.groupBy("group").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))


@query(
    "W1_frame_delta",
    f"{with_(EVENT_STEPS)} SELECT episode_index, event_id, x AS delta FROM steps",
    "delta", "episode_index event_id",
)
def deltas(spark, d):
    rows = event_rows(spark, d).select(*EVENT_KEYS, *EVENT_ORDER, "value")
    return st.frame_delta(rows, "value", EVENT_KEYS, EVENT_ORDER, time_block()).select("episode_index", "event_id", "delta")


@query(
    "W2_next_frame_gap",
    f"""{with_(EVENT_STEPS)} SELECT episode_index, event_id, gap, gap - lag(gap) OVER (
        PARTITION BY dataset, split, episode_index ORDER BY ts, event_id) AS gap_delta FROM steps WHERE gap IS NOT NULL""",
    "gap gap_delta", "episode_index event_id",
)
def gaps(spark, d):
    rows = event_rows(spark, d).select(*EVENT_KEYS, *EVENT_ORDER, "value", "k")
    out = st.next_frame_gap(rows, "value", "k", EVENT_KEYS, EVENT_ORDER, time_block())
    return out.select("episode_index", "event_id", "gap", "gap_delta")


@query(
    "A2_delta_statistics",
    f"{with_(EVENT_STEPS)} SELECT event_type, {DELTA}{SPEED} FROM steps GROUP BY event_type",
    f"{DELTA_DOUBLES} {SPEED_DOUBLES}", DELTA_INTS,
)
def delta_stats(spark, d):
    rows = event_rows(spark, d).select(*EVENT_KEYS, *EVENT_ORDER, "event_type", "value")
    steps = st.frame_delta(rows, "value", EVENT_KEYS, EVENT_ORDER, time_block())
    return st.delta_statistics(steps, ["event_type"], "delta", fps=30.0)


SOURCES = VEC_LONG + """,
near AS (SELECT *, lag(state) OVER w AS ps, lag(action) OVER w AS pa, lead(state) OVER w AS ns
  FROM long WINDOW w AS (PARTITION BY dataset, split, episode_index, joint_index ORDER BY frame_index)),
src AS (
  SELECT 'action' AS source, joint_index, action AS v, action - pa AS x FROM near
  UNION ALL SELECT 'observation.state', joint_index, state, state - ps FROM near
  UNION ALL SELECT 'action_minus_state', joint_index, action - state, (action - state) - (pa - ps) FROM near
  UNION ALL SELECT 'action_minus_next_state', joint_index, action - ns, (action - ns) - (pa - state) FROM near WHERE ns IS NOT NULL)"""


@query(
    "A3_command_state_gap",
    f"""{with_(SOURCES)} SELECT source, joint_index, count(v) AS samples, avg(v) AS mean, count(x) AS deltas,
        avg(abs(x)) AS mean_delta FROM src GROUP BY ALL""",
    "mean mean_delta", "joint_index samples deltas",
)
def command_gap(spark, d):
    rows = st.command_state_gap(vector_frames(spark, d))
    long = rows.select("source", F.posexplode(F.arrays_zip("values", "deltas")).alias("joint_index", "z"))
    return long.groupBy("source", "joint_index").agg(
        F.count("z.values").alias("samples"), F.avg("z.values").alias("mean"),
        F.count("z.deltas").alias("deltas"), F.avg(F.abs("z.deltas")).alias("mean_delta"),
    )


@query(
    "A3_joint_report",
    f"""{with_(SOURCES)} SELECT source, joint_index, 'joint_' || joint_index AS joint_name, {BASIC}, {DELTA}{SPEED},
        CAST(30 AS DOUBLE) AS sample_rate_hz FROM src GROUP BY source, joint_index""",
    f"{BASIC_DOUBLES} {DELTA_DOUBLES} {SPEED_DOUBLES} sample_rate_hz", f"{BASIC_INTS} {DELTA_INTS} joint_index",
)
def report(spark, d):
    return joint_report(vector_frames(spark, d), fps=30.0)


EPISODE = """min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_pop(value) AS std, count(value) AS count,
  quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.1) AS q10, quantile_cont(value, 0.5) AS q50,
  quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.99) AS q99"""
EPISODE_DOUBLES = "min max mean std q01 q10 q50 q90 q99"


@query(
    "A4_episode_stats",
    f"{with_(EVENTS)} SELECT dataset, split, episode_index, {EPISODE} FROM ev GROUP BY dataset, split, episode_index",
    EPISODE_DOUBLES, "episode_index count",
)
def per_episode(spark, d):
    return st.episode_stats(event_rows(spark, d), "value", EVENT_KEYS)


@query(
    "A5_merge_stats",
    f"""{with_(EVENTS)}, one AS (SELECT dataset, split, episode_index, {EPISODE} FROM ev GROUP BY dataset, split, episode_index),
        total AS (SELECT split, sum(mean * count) / sum(count) AS m FROM one GROUP BY split)
        SELECT split, min(min) AS min, max(max) AS max, max(m) AS mean,
          sqrt(sum((std * std + (mean - m) * (mean - m)) * count) / sum(count)) AS std, sum(count) AS count,
          sum(q01 * count) / sum(count) AS q01, sum(q10 * count) / sum(count) AS q10, sum(q50 * count) / sum(count) AS q50,
          sum(q90 * count) / sum(count) AS q90, sum(q99 * count) / sum(count) AS q99
        FROM one JOIN total USING (split) GROUP BY split""",
    EPISODE_DOUBLES, "count",
)
def pooled(spark, d):
    return st.merge_stats(st.episode_stats(event_rows(spark, d), "value", EVENT_KEYS), ["split"])


@query(
    "A6_relative_action_stats",
    f"""{with_(EVENTS)}, rel AS (SELECT a.k AS state, b.value - a.k AS value, b.frame_index - a.frame_index AS k
          FROM ev a JOIN ev b ON a.episode_index = b.episode_index AND b.frame_index BETWEEN a.frame_index AND a.frame_index + 31
          JOIN (SELECT episode_index, count(*) AS n FROM ev GROUP BY 1) s ON s.episode_index = a.episode_index
          WHERE a.frame_index + 31 < s.n)
        SELECT CAST(0 AS BIGINT) AS joint_index, k, count(value) AS sample_count, avg(value) AS mean, stddev_pop(value) AS std,
          min(value) AS min, max(value) AS max, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99
        FROM rel GROUP BY k""",
    "mean std min max q01 q99", "k sample_count",
)
def relative(spark, d):
    rows = event_frames(spark, d).select(
        *EVENT_KEYS, "frame_index", F.array("value").alias("action"), F.array("k").alias("state")
    )
    return st.relative_action_stats(rows)


@query(
    "A6_relative_sample_count",
    f"""{with_(EVENTS, EVENT_EPISODES)} SELECT dataset, split, sum(greatest(length - 31, 0)) AS sample_count
        FROM ep GROUP BY dataset, split""",
    ints="sample_count",
)
def relative_count(spark, d):
    return st.relative_sample_count(event_episodes(spark, d))


@query(
    "A7_dataset_totals",
    f"""{with_(TURNS)} SELECT e.dataset, e.split, e.n AS total_episodes, e.f AS total_frames, k.n AS total_tasks,
          CAST(ceil(e.n / 10.0) AS BIGINT) AS total_chunks, e.n * 2 AS total_videos, '0:' || e.n AS split_range
        FROM (SELECT dataset, split, count(*) AS n, sum(length) AS f FROM eps GROUP BY ALL) e
        JOIN (SELECT dataset, split, count(*) AS n FROM tasks GROUP BY ALL) k USING (dataset, split)""",
    ints="total_episodes total_frames total_tasks total_chunks total_videos",
)
def totals(spark, d):
    return st.dataset_totals(
        turn_episodes(spark, d), turn_tasks(spark, d), chunks_size=10, cameras=2, by=["dataset", "split"]
    )


@query(
    "A23_split_counts",
    f"""{with_(DOCS)} SELECT split, level, member, count(*) AS episodes, count(DISTINCT source_session) AS sessions,
          count(DISTINCT goal) AS goals FROM (
          SELECT *, 'split' AS level, 'all' AS member FROM docs UNION ALL SELECT *, 'goal', goal FROM docs
          UNION ALL SELECT *, 'component', source_dataset FROM docs) GROUP BY split, level, member""",
    ints="episodes sessions goals",
)
def counted(spark, d):
    return st.split_counts(doc_episodes(spark, d))


@query(
    "U3_pool_sources",
    f"""{with_(EVENTS)} SELECT count(v) AS n, avg(v) AS mean, quantile_cont(v, 0.5) AS middle FROM (
        SELECT value AS v FROM ev UNION ALL SELECT CAST(length(text) AS DOUBLE) FROM conversations)""",
    "mean middle", "n",
)
def pool(spark, d):
    from episodica.operators.quantiles import exact_quantiles, match

    rows = st.pool_sources(
        event_rows(spark, d).select(F.col("value").alias("v")),
        turn_frames(spark, d).select(F.col("size").alias("v")),
    )
    basic = rows.agg(F.count("v").alias("n"), F.avg("v").alias("mean"))
    return match(basic, exact_quantiles(rows, [], "v", {"middle": 0.5}), [])


@query(
    "U3_pooling_faults",
    f"""{with_(EVENTS)}, infos AS (SELECT split AS dataset, CAST(count(DISTINCT episode_index) AS DOUBLE) AS fps FROM ev GROUP BY split)
        SELECT 'fps differs' AS "check", CAST(NULL AS VARCHAR) AS dataset, CAST(min(fps) AS VARCHAR) || '-' || CAST(max(fps) AS VARCHAR) AS detail
        FROM infos HAVING max(fps) > min(fps)""",
)
def pool_faults(spark, d):
    rows = event_rows(spark, d).groupBy("split", "episode_index").agg(F.lit(1).alias("_one"))
    infos = rows.groupBy(F.col("split").alias("dataset")).agg(F.count(F.lit(1)).cast("double").alias("fps"))
    return st.pooling_faults(infos)
