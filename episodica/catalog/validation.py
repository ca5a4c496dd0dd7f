"""Validation queries with a fault planted for every rule; the SQL states the rules anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodica.catalog.base import (
    DOCS, EVENT_EPISODES, EVENTS, TURNS, doc_episodes, split_of, split_sql, table, turn_episodes, turn_frames, turn_tasks, union, with_,
)
from episodica.catalog.files import RAW, raw_episodes
from episodica.catalog.merging import MERGED
from episodica.catalog.registry import query
from episodica.operators import checks, dataset_checks, merge, numbering
from episodica.shared import checkpointed
from episodica.sources import scans

ROOT = ["dataset", "split"]

# --- one dataset per source and split, with faults by episode number ----------------------

PLANTED = TURNS + """,
e0 AS (SELECT dataset, split, episode_index AS i, length, sum(length) OVER (PARTITION BY dataset, split ORDER BY episode_index) - length AS first FROM eps),
pf AS (SELECT f.dataset, f.split, i, CASE WHEN i % 7 = 6 AND length > 3 AND frame_index = 1 THEN 2 WHEN i % 7 = 5 THEN frame_index + 1 ELSE frame_index END AS fi,
    CASE WHEN i % 6 = 4 AND frame_index = 0 THEN 999 ELSE task_index END AS task_index, first, i % 7 = 3 AS moved
  FROM frames f JOIN e0 ON e0.dataset = f.dataset AND e0.split = f.split AND e0.i = f.episode_index),
pframes AS (SELECT dataset, split, i, fi, first + fi + CASE WHEN moved THEN 5 ELSE 0 END AS idx, task_index FROM pf),
peps AS (SELECT dataset, split, i, length FROM e0 UNION ALL SELECT dataset, split, i, 0 FROM e0 WHERE i % 9 = 5),
pstats AS (SELECT dataset, split, i FROM e0 WHERE i % 5 <> 3 UNION ALL SELECT dataset, split, i FROM e0 WHERE i % 5 = 4
  UNION ALL SELECT DISTINCT dataset, split, 1000000 FROM e0),
ptasks AS (SELECT dataset, split, task_index, CASE WHEN dataset = 'left' AND task_index = 0 THEN NULL WHEN dataset = 'right' THEN 'same' ELSE task END AS task FROM tasks
  UNION ALL SELECT DISTINCT dataset, split, 0, 'extra' FROM tasks WHERE dataset = 'base'),
pinfo AS (SELECT e.dataset, e.split, CAST(e.n AS BIGINT) AS total_episodes, CAST(e.f AS BIGINT) + CASE WHEN e.split = 'test' THEN 1 ELSE 0 END AS total_frames,
    t.n + CASE WHEN e.dataset = 'right' THEN 1 ELSE 0 END AS total_tasks, CAST(e.f AS BIGINT) + CASE WHEN e.dataset = 'left' THEN 1 ELSE 0 END AS raw_depth_files,
    CASE WHEN e.dataset = 'right' THEN 'lossy' ELSE 'lossless_png' END AS raw_depth_storage
  FROM (SELECT dataset, split, count(*) AS n, sum(length) AS f FROM peps GROUP BY ALL) e JOIN (SELECT dataset, split, count(*) AS n FROM ptasks GROUP BY ALL) t USING (dataset, split)),
refs AS (SELECT dataset, split, i, 'data' AS kind, printf('%s/%s/data/%d', dataset, split, i) AS path FROM e0
  UNION ALL SELECT dataset, split, i, 'video', CASE WHEN i % 6 <> 3 THEN printf('%s/%s/video/%d', dataset, split, i) END FROM e0
  UNION ALL SELECT dataset, split, i, 'raw_depth', printf('%s/%s/raw/%d/%d', dataset, split, i, j) FROM (SELECT *, unnest(range(length)) AS j FROM e0)),
files AS (SELECT path FROM refs WHERE path IS NOT NULL AND NOT (kind = 'data' AND i % 6 = 2) AND NOT (i % 6 = 1 AND path LIKE '%/raw/%/0')),
pchunks AS (SELECT dataset, split, i, k + CASE WHEN i % 8 = 7 AND k > 0 THEN 1 ELSE 0 END AS chunk_index, 2 * k + CASE WHEN i % 8 = 3 AND k = 1 THEN 1 ELSE 0 END AS start_frame,
    CASE WHEN i % 8 = 4 AND k = 0 THEN 0 ELSE least(2, length - 2 * k) END AS frame_count, CASE WHEN i % 8 = 6 AND k = 1 THEN 2 ELSE 1 END AS height,
    least(2, length - 2 * k) * CASE WHEN i % 8 = 6 AND k = 1 THEN 2 ELSE 1 END + CASE WHEN i % 8 = 1 AND k = 0 THEN 1 ELSE 0 END AS bytes,
    CASE WHEN i % 8 = 2 AND k = 0 THEN NULL ELSE sha256(CAST(k AS VARCHAR)) END AS hash
  FROM (SELECT *, unnest(range(CAST(ceil(length / 2.0) AS BIGINT))) AS k FROM e0) WHERE NOT (i % 8 = 5 AND k = 1 AND k = CAST(ceil(length / 2.0) AS BIGINT) - 1))"""

RULES = """,
en AS (SELECT dataset, split, i, count(*) AS n, sum(length) AS length FROM peps GROUP BY ALL),
fn AS (SELECT dataset, split, i, count(*) AS n, min(fi) AS low, max(fi) AS high, min(idx - fi) AS a, max(idx - fi) AS b FROM pframes GROUP BY ALL),
fs AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY dataset, split ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM fn),
sn AS (SELECT dataset, split, i, count(*) AS n FROM pstats GROUP BY ALL),
tn AS (SELECT dataset, split, task_index, count(*) AS n FROM ptasks GROUP BY ALL),
root AS (SELECT dataset, split, sum(n) AS n, CAST(sum(length) AS BIGINT) AS f, min(i) AS low, max(i) AS high FROM en GROUP BY ALL),
troot AS (SELECT dataset, split, sum(n) AS n, min(task_index) AS low, max(task_index) AS high FROM tn GROUP BY ALL),
found AS (SELECT dataset, split, count(*) AS n FROM refs WHERE kind = 'raw_depth' AND path IN (SELECT path FROM files) GROUP BY ALL),
near AS (SELECT *, lag(chunk_index) OVER w AS pk, lag(start_frame) OVER w + lag(frame_count) OVER w AS ps FROM pchunks
  WINDOW w AS (PARTITION BY dataset, split, i ORDER BY chunk_index)),
cn AS (SELECT dataset, split, i, CAST(sum(frame_count) AS BIGINT) AS f, count(DISTINCT height) AS shapes FROM pchunks GROUP BY ALL),
faults AS (
  SELECT 'info' AS "check", dataset || '/' || split AS key, unnest(list_filter([CASE WHEN total_episodes <> r.n THEN 'total_episodes' END,
      CASE WHEN total_frames <> r.f THEN 'total_frames' END, CASE WHEN total_tasks <> t.n THEN 'total_tasks' END], lambda x: x IS NOT NULL)) AS detail
    FROM pinfo JOIN root r USING (dataset, split) JOIN troot t USING (dataset, split)
  UNION ALL SELECT 'episode indices', dataset || '/' || split, CAST(high AS VARCHAR) FROM root WHERE low <> 0 OR high <> n - 1
  UNION ALL SELECT 'task indices', dataset || '/' || split, n || ' in ' || low || '..' || high FROM troot WHERE low <> 0 OR high <> n - 1
  UNION ALL SELECT 'raw_depth total', dataset || '/' || split, CAST(raw_depth_files AS VARCHAR) FROM pinfo WHERE raw_depth_files <> total_frames
  UNION ALL SELECT 'raw_depth storage', dataset || '/' || split, raw_depth_storage FROM pinfo WHERE raw_depth_storage <> 'lossless_png'
  UNION ALL SELECT 'raw_depth files', dataset || '/' || split, CAST(n AS VARCHAR) FROM pinfo JOIN found USING (dataset, split) WHERE n <> total_frames
  UNION ALL SELECT 'coverage', dataset || '/' || split || '/' || i, 'no record' FROM en WHERE (dataset, split, i) NOT IN (SELECT (dataset, split, i) FROM sn)
  UNION ALL SELECT 'coverage', dataset || '/' || split || '/' || i, 'no episode' FROM sn WHERE (dataset, split, i) NOT IN (SELECT (dataset, split, i) FROM en)
  UNION ALL SELECT 'episode repeated', dataset || '/' || split || '/' || i, CAST(n AS VARCHAR) FROM en WHERE n > 1
  UNION ALL SELECT 'record repeated', dataset || '/' || split || '/' || i, CAST(n AS VARCHAR) FROM sn WHERE n > 1
  UNION ALL SELECT 'length', dataset || '/' || split || '/' || i, CAST(f.n AS VARCHAR) FROM en JOIN fn f USING (dataset, split, i) WHERE f.n <> length
  UNION ALL SELECT 'frame_index', dataset || '/' || split || '/' || i, n || ' rows in ' || low || '..' || high FROM fn WHERE low <> 0 OR high <> n - 1
  UNION ALL SELECT 'frame_index repeated', dataset || '/' || split || '/' || i, CAST(count(*) AS VARCHAR) FROM
    (SELECT dataset, split, i, fi FROM pframes GROUP BY ALL HAVING count(*) > 1) GROUP BY dataset, split, i
  UNION ALL SELECT 'global index', dataset || '/' || split || '/' || i, CAST(first AS VARCHAR) FROM fs WHERE a <> b OR a <> first
  UNION ALL SELECT 'task_index', dataset || '/' || split || '/' || task_index, CAST(count(*) AS VARCHAR) FROM pframes
    WHERE (dataset, split, task_index) NOT IN (SELECT (dataset, split, task_index) FROM tn) GROUP BY dataset, split, task_index
  UNION ALL SELECT 'task index repeated', dataset || '/' || split || '/' || task_index, CAST(n AS VARCHAR) FROM tn WHERE n > 1
  UNION ALL SELECT 'task text', dataset || '/' || split || '/' || task_index, 'missing' FROM ptasks WHERE task IS NULL
  UNION ALL SELECT 'task text repeated', dataset || '/' || split || '/' || task, CAST(count(*) AS VARCHAR) FROM ptasks WHERE task IS NOT NULL GROUP BY dataset, split, task HAVING count(*) > 1
  UNION ALL SELECT CASE WHEN path IS NULL THEN 'no reference' ELSE 'missing file' END, dataset || '/' || split || '/' || i, path FROM refs WHERE path IS NULL OR path NOT IN (SELECT path FROM files)
  UNION ALL SELECT 'chunk', dataset || '/' || split || '/' || i || '/' || chunk_index, CASE WHEN chunk_index <> coalesce(pk + 1, 0) THEN 'chunk_index'
      WHEN start_frame <> coalesce(ps, 0) THEN 'start_frame' WHEN frame_count NOT BETWEEN 1 AND 32 THEN 'frame_count' WHEN bytes <> frame_count * height THEN 'uncompressed_bytes' ELSE 'sha256' END
    FROM near WHERE chunk_index <> coalesce(pk + 1, 0) OR start_frame <> coalesce(ps, 0) OR frame_count NOT BETWEEN 1 AND 32 OR bytes <> frame_count * height OR hash IS NULL
  UNION ALL SELECT 'chunk shape', dataset || '/' || split || '/' || i, 'shape differs' FROM cn WHERE shapes > 1
  UNION ALL SELECT 'chunk frames', dataset || '/' || split || '/' || en.i, CAST(f AS VARCHAR) FROM en LEFT JOIN cn USING (dataset, split, i) WHERE f IS DISTINCT FROM CAST(length AS BIGINT))"""


def planted(spark, d) -> dict[str, DataFrame]:
    """All tables of the datasets with their faults; the parts that several of them use are checkpointed."""
    episodes, tasks = checkpointed(turn_episodes(spark, d)), checkpointed(turn_tasks(spark, d))
    e = numbering.renumber_episodes(episodes.drop("conv_id").withColumn("_whole", F.lit(0)), ROOT, "_whole")
    e = checkpointed(e.select(*ROOT, F.col("episode_index").alias("i"), "length", F.col("first_index").alias("first")))
    i = F.col("i")
    frames = turn_frames(spark, d, episodes, tasks).select(*ROOT, F.col("episode_index").alias("i"), "frame_index", "task_index").join(e, [*ROOT, "i"])
    at = F.when((i % 7 == 6) & (F.col("length") > 3) & (F.col("frame_index") == 1), 2).when(i % 7 == 5, F.col("frame_index") + 1).otherwise(F.col("frame_index"))
    frames = frames.select(
        *ROOT, i.alias("episode_index"), at.alias("frame_index"),
        (F.col("first") + at + F.when(i % 7 == 3, 5).otherwise(0)).alias("index"),
        F.when((i % 6 == 4) & (F.col("frame_index") == 0), 999).otherwise(F.col("task_index")).alias("task_index"),
    )
    named = e.withColumnRenamed("i", "episode_index")
    n = F.col("episode_index")
    all_episodes = union(named.select(*ROOT, "episode_index", "length"), named.where(n % 9 == 5).select(*ROOT, "episode_index", F.lit(0).cast("long").alias("length")))
    stats = union(
        named.where(n % 5 != 3).select(*ROOT, "episode_index"), named.where(n % 5 == 4).select(*ROOT, "episode_index"),
        named.select(*ROOT).distinct().withColumn("episode_index", F.lit(1000000).cast("long")),
    )
    text = F.when((F.col("dataset") == "left") & (F.col("task_index") == 0), None).when(F.col("dataset") == "right", "same").otherwise(F.col("task"))
    all_tasks = union(
        tasks.select(*ROOT, "task_index", text.alias("task")),
        tasks.where("dataset = 'base'").select(*ROOT).distinct().select(*ROOT, F.lit(0).cast("long").alias("task_index"), F.lit("extra").alias("task")),
    )
    info = all_episodes.groupBy(*ROOT).agg(F.count(F.lit(1)).alias("total_episodes"), F.sum("length").alias("f"))
    info = info.join(all_tasks.groupBy(*ROOT).agg(F.count(F.lit(1)).alias("t")), ROOT)
    one = lambda test: F.when(test, 1).otherwise(0)
    info = info.select(
        *ROOT, "total_episodes", (F.col("f") + one(F.col("split") == "test")).alias("total_frames"),
        (F.col("t") + one(F.col("dataset") == "right")).alias("total_tasks"),
        (F.col("f") + one(F.col("dataset") == "left")).alias("raw_depth_files"),
        F.when(F.col("dataset") == "right", "lossy").otherwise("lossless_png").alias("raw_depth_storage"),
    )
    place = F.concat_ws("/", "dataset", "split")
    whole = named.select(*ROOT).distinct()
    references = dataset_checks.expected_media(
        whole, named,
        {"data": F.concat_ws("/", place, F.lit("data"), n.cast("string")), "video": F.concat_ws("/", place, F.lit("video"), n.cast("string"))},
        {"raw_depth": F.concat_ws("/", place, F.lit("raw"), n.cast("string"), F.col("frame_index").cast("string"))},
    )
    lost = ((F.col("kind") == "data") & (n % 6 == 2)) | ((F.col("kind") == "raw_depth") & (n % 6 == 1) & F.col("path").endswith("/0"))
    unnamed = (F.col("kind") == "video") & (n % 6 == 3)
    inventory = references.where(~lost & ~unnamed).select("path")
    references = references.withColumn("path", F.when(~unnamed, F.col("path")))
    steps = e.withColumn("k", F.explode(F.expr("sequence(0, CAST(ceil(length / 2) AS BIGINT) - 1)")))
    k, m = F.col("k"), i % 8
    size = F.least(F.lit(2), F.col("length") - 2 * k)
    steps = steps.where(~((m == 5) & (k == 1) & (k == F.expr("CAST(ceil(length / 2) AS BIGINT) - 1"))))
    high = F.when((m == 6) & (k == 1), 2).otherwise(1)
    chunks = steps.select(
        *ROOT, i.alias("episode_index"), (k + one((m == 7) & (k > 0))).alias("chunk_index"), (2 * k + one((m == 3) & (k == 1))).alias("start_frame"),
        F.when((m == 4) & (k == 0), 0).otherwise(size).alias("frame_count"), high.alias("height"), F.lit(1).alias("width"), F.lit(1).alias("channels"),
        (size * high + one((m == 1) & (k == 0))).alias("uncompressed_bytes"),
        F.when(~((m == 2) & (k == 0)), F.sha2(k.cast("string"), 256)).alias("compressed_sha256"),
    )
    return {
        "info": info, "tasks": all_tasks, "episodes": all_episodes, "stats": stats, "frames": frames,
        "references": references, "inventory": inventory, "chunks": chunks,
    }


@query("V1_every_rule", f'{with_(PLANTED + RULES)} SELECT * FROM faults')
def every_rule(spark, d):
    return dataset_checks.validate_dataset(**planted(spark, d))


@query(
    "W12_check_index",
    f"""{with_(PLANTED + RULES)} SELECT * FROM faults WHERE "check" IN ('frame_index', 'frame_index repeated', 'global index', 'task_index')""",
)
def contiguous(spark, d):
    tables = planted(spark, d)
    return dataset_checks.check_contiguous(tables["frames"], [*ROOT, "episode_index"], tasks=tables["tasks"])


# --- provenance of a merge ------------------------------------------------------------------

RECORDS = MERGED + """,
sizes AS (SELECT split, CAST(sum(length) AS BIGINT) AS total FROM merged_eps GROUP BY split),
rec AS (
  SELECT split, episode_index AS i, length + CASE WHEN episode_index % 9 = 3 THEN 1 ELSE 0 END AS n,
    CAST(first_index AS BIGINT) + CASE WHEN episode_index % 9 = 4 THEN 1 ELSE 0 END AS a, CAST(first_index AS BIGINT) + length + CASE WHEN episode_index % 9 = 5 THEN 1 ELSE 0 END AS b,
    CASE episode_index % 9 WHEN 6 THEN 'sha256:zz' WHEN 7 THEN 'sha256:' || sha256('other') WHEN 8 THEN 'sha256:' || sha256(split) END AS f
  FROM merged_eps WHERE episode_index % 9 <> 1
  UNION ALL SELECT split, episode_index, length, CAST(first_index AS BIGINT), CAST(first_index AS BIGINT) + length, NULL FROM merged_eps WHERE episode_index % 9 = 2
  UNION ALL SELECT split, 1000000, 5, total, total + 5, NULL FROM sizes
  UNION ALL SELECT split, 1000001, 5, 7, 7, NULL FROM sizes),
recn AS (SELECT split, i, count(*) AS n, min(n) AS low, max(n) AS high FROM rec GROUP BY ALL),
swept AS (SELECT r.*, total, coalesce(max(b) OVER (PARTITION BY r.split ORDER BY a, b, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach
  FROM rec r JOIN sizes USING (split) WHERE b > a)"""


@query(
    "V9_provenance_coverage",
    f"""{with_(RECORDS)}
    SELECT 'no record' AS "check", split || '/' || episode_index AS key, CAST(length AS VARCHAR) AS detail FROM merged_eps WHERE (split, episode_index) NOT IN (SELECT (split, i) FROM recn)
    UNION ALL SELECT 'out of range', split || '/' || i, CAST(n AS VARCHAR) FROM recn WHERE (split, i) NOT IN (SELECT (split, episode_index) FROM merged_eps)
    UNION ALL SELECT 'repeated index', split || '/' || i, CAST(n AS VARCHAR) FROM recn WHERE n > 1
    UNION ALL SELECT 'length', m.split || '/' || i, CAST(high AS VARCHAR) FROM recn r JOIN merged_eps m ON m.split = r.split AND m.episode_index = i WHERE low <> length OR high <> length
    UNION ALL SELECT 'gap', split || '/' || i, reach || '-' || a FROM swept WHERE a > reach
    UNION ALL SELECT 'overlap', split || '/' || i, a || '-' || least(reach, b) FROM swept WHERE a < reach
    UNION ALL SELECT 'outside', split || '/' || i, CAST(b AS VARCHAR) FROM swept WHERE b > total
    UNION ALL SELECT 'empty range', split || '/' || i, a || '-' || b FROM rec WHERE b <= a
    UNION ALL SELECT 'gap', split || '/end', max(b) || '-' || any_value(total) FROM swept GROUP BY split HAVING max(b) < any_value(total)
    UNION ALL SELECT 'calibration', split || '/' || i, CASE WHEN f = 'sha256:zz' THEN 'form' ELSE 'differs from info' END FROM rec WHERE f IS NOT NULL AND f <> 'sha256:' || sha256(split)""",
)
def provenance_coverage(spark, d):
    episodes = checkpointed(numbering.renumber_episodes(turn_episodes(spark, d).drop("dataset", "conv_id")))
    i, first = F.col("new_episode_index"), F.col("first_index")
    m = i % 9
    one = lambda test: F.when(test, 1).otherwise(0)
    declared = F.when(m == 6, "sha256:zz").when(m == 7, F.concat(F.lit("sha256:"), F.sha2(F.lit("other"), 256))).when(m == 8, F.concat(F.lit("sha256:"), F.sha2("split", 256)))

    def record(rows, index, size, start, end, mark):
        return rows.select(
            "split", index.cast("long").alias("final_episode_index"), size.cast("long").alias("frame_count"), start.cast("long").alias("final_index_start"),
            end.cast("long").alias("final_index_end_exclusive"), mark.cast("string").alias("camera_calibration_fingerprint"),
        )

    none, total = F.lit(None), F.col("total")
    sizes = episodes.groupBy("split").agg(F.sum("length").alias("total"))
    end = first + F.col("length")
    records = union(
        record(episodes.where(m != 1), i, F.col("length") + one(m == 3), first + one(m == 4), end + one(m == 5), declared),
        record(episodes.where(m == 2), i, F.col("length"), first, end, none),
        record(sizes, F.lit(1000000), F.lit(5), total, total + 5, none),
        record(sizes, F.lit(1000001), F.lit(5), F.lit(7), F.lit(7), none),
    )
    marks = sizes.select("split", F.concat(F.lit("sha256:"), F.sha2("split", 256)).alias("fingerprint"))
    merged = episodes.select("split", i.alias("episode_index"), "length")
    return merge.provenance_coverage(merged, records, marks)


# --- statistics that must not change -----------------------------------------------------------

@query(
    "V6_held_out_untouched",
    """WITH b AS (SELECT lang, source, n_chars AS n, doc_id FROM documents),
         a AS (SELECT lang, source, n + CASE WHEN lang = 'de' AND doc_id % 97 = 0 THEN 1 ELSE 0 END AS n FROM b WHERE NOT (lang = 'fr' AND doc_id % 41 = 0)
           UNION ALL SELECT 'xx', source, n FROM b WHERE doc_id % 50 = 0),
         x AS (SELECT lang, source, list(n ORDER BY n) AS l FROM b GROUP BY ALL), y AS (SELECT lang, source, list(n ORDER BY n) AS l FROM a GROUP BY ALL)
       SELECT 'held-out statistics' AS "check", coalesce(x.lang, y.lang) || '/' || coalesce(x.source, y.source) AS key,
         CASE WHEN y.l IS NULL THEN 'missing' WHEN x.l IS NULL THEN 'unexpected' ELSE 'changed' END AS detail
       FROM x FULL JOIN y ON x.lang = y.lang AND x.source = y.source WHERE x.l IS DISTINCT FROM y.l""",
)
def untouched(spark, d):
    """Rows in another order are equal; changed, lost and added ones are not."""
    before = table(spark, d, "documents").select("lang", "source", "doc_id", F.col("n_chars").alias("n"))
    changed = F.when((F.col("lang") == "de") & (F.col("doc_id") % 97 == 0), 1).otherwise(0)
    after = union(
        before.where("doc_id % 50 = 0").select(F.lit("xx").alias("lang"), "source", "n"),
        before.where("NOT (lang = 'fr' AND doc_id % 41 = 0)").select("lang", "source", (F.col("n") + changed).alias("n")),
    )
    return checks.unchanged(before.drop("doc_id"), after, ["lang", "source"])


# --- manifest, raw and converted episodes -------------------------------------------------------

SIDES = DOCS + """,
num AS (SELECT split, doc_id, goal, frame_count, data_json_sha256 AS h, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS n FROM docs),
man AS (SELECT split, CASE WHEN n % 31 = 0 THEN 'broken' || doc_id ELSE printf('episode_%04d', n) END AS e, frame_count AS f, goal AS g, h FROM num
  UNION ALL SELECT split, printf('episode_%04d', n), frame_count, goal, h FROM num WHERE n % 37 = 1),
raw AS (SELECT split, printf('episode_%04d', n) AS e, frame_count + CASE WHEN n % 11 = 2 THEN 1 ELSE 0 END AS f, CASE WHEN n % 11 = 3 THEN 'other' ELSE goal END AS g,
    CASE WHEN n % 11 = 4 THEN sha256('x') ELSE h END AS h FROM num WHERE n % 11 <> 5),
conv AS (SELECT split, printf('episode_%04d', n) AS e, frame_count + CASE WHEN n % 13 = 2 THEN 1 ELSE 0 END AS f, CASE WHEN n % 13 = 3 THEN 'other' ELSE goal END AS g,
    n - 1 + CASE WHEN n % 13 = 4 THEN 1 ELSE 0 END AS i FROM num WHERE n % 13 <> 5),
m AS (SELECT split, e, count(*) AS n, max(f) AS f, max(g) AS g, max(h) AS h, CASE WHEN e LIKE 'episode_%' THEN CAST(substr(e, 9) AS BIGINT) END AS k FROM man GROUP BY split, e),
keys AS (SELECT split, e FROM m UNION SELECT split, e FROM raw UNION SELECT split, e FROM conv),
met AS (SELECT keys.split, keys.e, keys.split || '/' || keys.e AS key, m.n, m.k, m.f AS mf, m.g AS mg, m.h AS mh, r.f AS rf, r.g AS rg, r.h AS rh, c.f AS cf, c.g AS cg, c.i AS ci
  FROM keys LEFT JOIN m ON m.split = keys.split AND m.e = keys.e LEFT JOIN raw r ON r.split = keys.split AND r.e = keys.e LEFT JOIN conv c ON c.split = keys.split AND c.e = keys.e)"""


@query(
    "V5_reconcile_manifest",
    f"""{with_(SIDES)}
    SELECT 'missing' AS "check", key, 'manifest' AS detail FROM met WHERE mf IS NULL
    UNION ALL SELECT 'missing', key, 'raw' FROM met WHERE rf IS NULL UNION ALL SELECT 'missing', key, 'converted' FROM met WHERE cf IS NULL
    UNION ALL SELECT 'repeated', key, 'manifest' FROM met WHERE n > 1
    UNION ALL SELECT 'raw frame_count', key, CAST(rf AS VARCHAR) FROM met WHERE mf <> rf UNION ALL SELECT 'raw goal', key, rg FROM met WHERE mg <> rg
    UNION ALL SELECT 'raw hash', key, rh FROM met WHERE mh <> rh
    UNION ALL SELECT 'converted frame_count', key, CAST(cf AS VARCHAR) FROM met WHERE mf <> cf UNION ALL SELECT 'converted goal', key, cg FROM met WHERE mg <> cg
    UNION ALL SELECT 'name', key, e FROM met WHERE mf IS NOT NULL AND k IS NULL
    UNION ALL SELECT 'converted index', key, CAST(ci AS VARCHAR) FROM met WHERE ci <> k - 1
    UNION ALL SELECT 'names not contiguous', split, n || ' in ' || low || '..' || high FROM (SELECT split, count(mf) AS n, min(CASE WHEN e LIKE 'episode_%' THEN CAST(substr(e, 9) AS BIGINT) END) AS low,
        max(CASE WHEN e LIKE 'episode_%' THEN CAST(substr(e, 9) AS BIGINT) END) AS high FROM met GROUP BY split) WHERE low <> 1 OR high <> n
    UNION ALL SELECT 'total_frames', split, CAST(CAST(sum(cf) AS BIGINT) AS VARCHAR) FROM met WHERE split <> 'train' GROUP BY split""",
)
def reconciled(spark, d):
    """Each side planted wrong; the totals of the held-out splits as well."""
    docs = doc_episodes(spark, d)
    numbered = numbering.split_names(docs.withColumn("component_rank", F.lit(0))).select("split", "doc_id", "goal", "frame_count", "data_json_sha256", "split_episode")
    rows = checkpointed(numbered.withColumn("n", F.expr("CAST(substr(split_episode, 9) AS BIGINT)")))
    n, size = F.col("n"), F.col("frame_count")
    one = lambda test: F.when(test, 1).otherwise(0)
    broken = F.when(n % 31 == 0, F.concat(F.lit("broken"), F.col("doc_id").cast("string"))).otherwise(F.col("split_episode"))
    columns = ["split", "split_episode", "frame_count", "goal", "data_json_sha256"]
    manifest = union(rows.withColumn("split_episode", broken).select(columns), rows.where(n % 37 == 1).select(columns))
    raw = rows.where(n % 11 != 5).select(
        "split", "split_episode", (size + one(n % 11 == 2)).alias("frame_count"), F.when(n % 11 == 3, "other").otherwise(F.col("goal")).alias("goal"),
        F.when(n % 11 == 4, F.sha2(F.lit("x"), 256)).otherwise(F.col("data_json_sha256")).alias("data_json_sha256"),
    )
    converted = rows.where(n % 13 != 5).select(
        "split", "split_episode", (size + one(n % 13 == 2)).alias("length"), F.when(n % 13 == 3, "other").otherwise(F.col("goal")).alias("goal"),
        (n - 1 + one(n % 13 == 4)).alias("episode_index"),
    )
    infos = converted.groupBy("split").agg((F.sum("length") + one(F.first("split") != "train")).alias("total_frames"))
    return checks.reconcile_manifest(manifest, raw, converted, infos)


# --- raw episodes: who belongs to a source -------------------------------------------------------

@query(
    "V3_audit_members",
    f"""{with_(EVENTS, EVENT_EPISODES, RAW)}
        SELECT 'membership' AS "check", episode AS key, 'unexpected' AS detail FROM rawep WHERE raw_number % 1000000 = 3
        UNION ALL SELECT 'membership', 'episode_9999', 'missing'
        UNION ALL SELECT 'total episodes', NULL, CAST(count(*) AS VARCHAR) FROM rawep
        UNION ALL SELECT 'total frames', NULL, CAST(CAST(sum(length) AS BIGINT) AS VARCHAR) FROM rawep
        UNION ALL SELECT 'goal', episode, task FROM rawep WHERE task <> 'pick'
        UNION ALL SELECT 'timestamp', printf('episode_%04d', raw_number) || '/' || raw_frame, 'falls' FROM (
          SELECT *, lag(event_id) OVER (PARTITION BY raw_number ORDER BY raw_frame) AS b FROM rawev) WHERE event_id < b
        UNION ALL SELECT part, printf('episode_%04d', raw_number) || '/' || raw_frame, '7' FROM rawev, (VALUES ('states.left_ee')) AS p(part) WHERE event_type = 'error'""",
)
def members(spark, d):
    """Third pieces are not expected, one episode and both totals are wrong, and error events have a broken vector."""
    episodes = raw_episodes(spark, d)
    frames = scans.raw_frames(episodes)
    # The number of the first joint of an error event is lost.
    errors = table(spark, d, "events").where("event_type = 'error'").select(F.col("event_id").cast("double").alias("timestamp_s"), F.lit(True).alias("_error"))
    frames = frames.join(errors, "timestamp_s", "left")
    lost = F.transform(F.col("states.left_ee.qpos"), lambda x, j: F.when(j == 0, F.lit(float("nan"))).otherwise(x))
    part = F.col("states").withField("left_ee", F.struct(F.when(F.col("_error"), lost).otherwise(F.col("states.left_ee.qpos")).alias("qpos")))
    frames = frames.withColumn("states", part).drop("_error")
    expected = union(episodes.where("episode_number % 1000000 <> 3").select("episode"), spark.range(1).select(F.lit("episode_9999").alias("episode")))
    return checks.audit_raw_source(frames, episodes, None, "pick", members=expected, totals=(-1, -1))
