"""Merge and check queries over conversations in three datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.catalog.base import (
    DOCS, EVENT_EPISODES, EVENTS, TURNS, VECTORS, doc_episodes, event_episodes, event_frames, event_rows, split_of,
    table, turn_episodes, turn_frames, turn_rows, turn_tasks, vector_rows, with_,
)
from episodica.catalog.registry import query
from episodica.operators import checks, dataset_checks, donors, merge, numbering
from episodica.operators import statistics as st
from episodica.operators.ordered import index_block, row_numbers
from episodica.plans.append import append_report
from episodica.shared import checkpointed

MERGED = TURNS + """,
first AS (SELECT split, task, min(source_rank * 1000000 + task_index) AS pos FROM tasks GROUP BY split, task),
merged_tasks AS (SELECT split, task, row_number() OVER (PARTITION BY split ORDER BY pos) - 1 AS task_index FROM first),
merged_eps AS (SELECT dataset, source_rank, split, conv_id, episode_index AS source_episode_index, length,
    row_number() OVER w - 1 AS episode_index,
    coalesce(sum(length) OVER (PARTITION BY split ORDER BY source_rank, episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_index
  FROM eps WINDOW w AS (PARTITION BY split ORDER BY source_rank, episode_index)),
merged AS (SELECT f.split, f.source_rank, m.episode_index, f.frame_index, m.first_index + f.frame_index AS "index", t.task_index, f.size
  FROM frames f JOIN merged_eps m USING (split, source_rank, conv_id) JOIN merged_tasks t ON t.split = f.split AND t.task = f.role)"""


def parts(spark, d):
    """Frames, episodes and tasks; the small tables are made once."""
    episodes, tasks = checkpointed(turn_episodes(spark, d)), checkpointed(turn_tasks(spark, d))
    return turn_frames(spark, d, episodes, tasks), episodes, tasks


@query(
    "J2_merged_tasks",
    f"{with_(MERGED)} SELECT split, task, task_index FROM merged_tasks",
    ints="task_index",
)
def merged_tasks(spark, d):
    return merge.merged_tasks(turn_tasks(spark, d), ["split"])


@query(
    "J2_remap_tasks",
    f"""{with_(MERGED)} SELECT f.split, f.source_rank, f.conv_id, f.frame_index, t.task_index
        FROM frames f JOIN merged_tasks t ON t.split = f.split AND t.task = f.role""",
    ints="source_rank conv_id frame_index task_index",
)
def remapped(spark, d):
    frames, _, tasks = parts(spark, d)
    mapping = merge.task_map(tasks, merge.merged_tasks(tasks, ["split"]), ["split"])
    out = merge.remap_tasks(frames, mapping, ["split"])
    return out.select("split", "source_rank", "conv_id", "frame_index", "task_index")


@query(
    "J2_missing_tasks",
    f"""{with_(TURNS)} SELECT dataset, split, task_index, count(*) AS frames FROM frames
        WHERE (dataset, split, task_index) NOT IN (SELECT (dataset, split, task_index) FROM tasks WHERE task <> 'system')
        GROUP BY ALL""",
    ints="task_index frames",
)
def lost_tasks(spark, d):
    frames, _, tasks = parts(spark, d)
    return merge.missing_tasks(frames, tasks.where("task <> 'system'"), ["dataset", "split", "task_index"])


@query(
    "W9_renumber",
    f"""{with_(MERGED)} SELECT split, source_rank, source_episode_index AS episode_index, length,
        episode_index AS new_episode_index, first_index FROM merged_eps""",
    ints="source_rank episode_index length new_episode_index first_index",
)
def renumbered(spark, d):
    return numbering.renumber_episodes(turn_episodes(spark, d).drop("dataset", "conv_id"))


@query(
    "U1_append_datasets",
    f"""{with_(TURNS)}, m AS (SELECT dataset, split, conv_id, role, size, frame_index, source_rank FROM turns),
        o AS (SELECT source_rank, split, conv_id, count(*) AS length,
            row_number() OVER (ORDER BY source_rank, split, conv_id) - 1 AS episode_index FROM turns GROUP BY source_rank, split, conv_id),
        s AS (SELECT *, coalesce(sum(length) OVER (ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_index FROM o),
        t AS (SELECT role, row_number() OVER (ORDER BY min(source_rank * 1000 + r)) - 1 AS task_index FROM
          (SELECT source_rank, role, row_number() OVER (PARTITION BY source_rank ORDER BY role) AS r FROM (SELECT DISTINCT source_rank, role FROM turns)) GROUP BY role)
        SELECT s.episode_index, frame_index, first_index + frame_index AS "index", t.task_index, size
        FROM m JOIN s USING (source_rank, split, conv_id) JOIN t USING (role)""",
    "size", "episode_index frame_index index task_index",
)
def appended(spark, d):
    """Whole datasets: the splits of a source follow each other."""
    rows = turn_rows(spark, d).drop("text")
    order = F.when(F.col("split") == "test", 0).when(F.col("split") == "train", 1).otherwise(2)
    rows = rows.withColumn("_split", order)
    sizes = rows.groupBy("source_rank", "_split", "conv_id").agg(F.count(F.lit(1)).alias("length"))
    episodes = row_numbers(
        sizes, ["source_rank"], ["_split", "conv_id"], [F.col("_split"), index_block("conv_id")], "episode_index", 0
    )
    from pyspark.sql import Window

    roles = rows.groupBy("source_rank", F.col("role").alias("task")).agg(F.lit(1).alias("_one")).drop("_one")
    number = F.row_number().over(Window.partitionBy("source_rank").orderBy("task")) - 1
    tasks = roles.withColumn("task_index", number.cast("long"))
    frames = rows.join(episodes.select("source_rank", "conv_id", "episode_index"), ["source_rank", "conv_id"])
    frames = frames.join(tasks.withColumnRenamed("task", "role"), ["source_rank", "role"])
    out, _, _ = merge.append_datasets(frames, episodes, tasks)
    return out.select("episode_index", "frame_index", "index", "task_index", "size")


@query(
    "U2_append_split_roots",
    f'{with_(MERGED)} SELECT split, source_rank, episode_index, frame_index, "index", task_index, size FROM merged',
    "size", "source_rank episode_index frame_index index task_index",
)
def appended_roots(spark, d):
    out, _, _ = merge.append_split_roots(*parts(spark, d))
    return out.select("split", "source_rank", "episode_index", "frame_index", "index", "task_index", "size")


@query(
    "S15_combined_view",
    f"""{with_(MERGED)} SELECT split, count(*) AS frames, count(DISTINCT episode_index) AS episodes, max("index") AS last_index,
        count(DISTINCT task_index) AS tasks FROM merged GROUP BY split""",
    ints="frames episodes last_index tasks",
)
def view(spark, d):
    merge.combined_view(*parts(spark, d), name="combined")
    return spark.sql(
        """SELECT split, count(*) AS frames, count(DISTINCT episode_index) AS episodes,
           max(index) AS last_index, count(DISTINCT task_index) AS tasks FROM combined_frames GROUP BY split"""
    )


@query(
    "U5_fold_train_validation",
    f"""{with_(TURNS)}, f AS (SELECT *, CASE split WHEN 'validation' THEN 1 ELSE 0 END AS r FROM frames WHERE dataset = dataset AND split <> 'test'),
        e AS (SELECT dataset, r, episode_index, count(*) AS length FROM f GROUP BY ALL),
        n AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY r, episode_index) - 1 AS new_index,
          coalesce(sum(length) OVER (PARTITION BY dataset ORDER BY r, episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_index FROM e),
        t AS (SELECT dataset, task, row_number() OVER (PARTITION BY dataset ORDER BY min(CASE split WHEN 'validation' THEN 1000 ELSE 0 END + task_index)) - 1 AS task_index
          FROM tasks WHERE split <> 'test' GROUP BY dataset, task)
        SELECT f.dataset, n.new_index AS episode_index, f.frame_index, n.first_index + f.frame_index AS "index", t.task_index
        FROM f JOIN n ON n.dataset = f.dataset AND n.r = f.r AND n.episode_index = f.episode_index JOIN t ON t.dataset = f.dataset AND t.task = f.role""",
    ints="episode_index frame_index index task_index",
)
def folded(spark, d):
    """All three datasets at once, each folded for itself."""
    rank = F.when(F.col("split") == "validation", 1).otherwise(0)
    frames, episodes, tasks = (
        p.where(F.col("split").isin("train", "validation")).withColumn("source_rank", rank).drop("split")
        for p in parts(spark, d)
    )
    out, _, _ = merge.append_datasets(frames, episodes, tasks, by=["dataset"])
    return out.select("dataset", "episode_index", "frame_index", "index", "task_index")


@query(
    "J15_share_tasks",
    f"""{with_(TURNS)}, t AS (SELECT task, row_number() OVER (ORDER BY min(source_rank * 10000 +
            CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1000 ELSE 2000 END + task_index)) - 1 AS shared FROM tasks GROUP BY task)
        SELECT dataset, split, conv_id, frame_index, shared AS task_index FROM frames JOIN t ON t.task = frames.role""",
    ints="conv_id frame_index task_index",
)
def shared(spark, d):
    frames, _, tasks = parts(spark, d)
    split = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1).otherwise(2)
    rank = F.col("source_rank") * 10 + split
    out, _ = merge.share_tasks(frames, tasks, rank)
    return out.select("dataset", "split", "conv_id", "frame_index", "task_index")


@query(
    "J11_subset_episodes",
    f"""{with_(EVENTS, EVENT_EPISODES)}, c AS (SELECT episode_index, length FROM ep WHERE length > (SELECT avg(length) FROM ep)),
        o AS (SELECT episode_index, row_number() OVER (ORDER BY 1000000 - episode_index) - 1 AS new_index,
          coalesce(sum(length) OVER (ORDER BY 1000000 - episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_index FROM c)
        SELECT event_id, new_index AS episode_index, first_index + frame_index AS "index" FROM ev JOIN o USING (episode_index)""",
    ints="event_id episode_index index",
)
def subset(spark, d):
    """The episodes longer than the mean, last one first."""
    episodes = event_episodes(spark, d)
    mean = episodes.agg(F.avg("length").alias("m"))
    chosen = episodes.where(F.col("length") > mean.scalar())
    chosen = chosen.withColumn("position", F.lit(1000000) - F.col("episode_index"))
    out, _ = merge.subset_episodes(event_frames(spark, d), chosen)
    return out.select("event_id", "episode_index", "index")


@query(
    "J1_attach_provenance",
    f"""{with_(DOCS)} SELECT split, episode_index, goal, quality, coalesce(CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, 'base') AS cohort
        FROM docs LEFT JOIN labels USING (doc_id)""",
    ints="episode_index quality",
)
def attached(spark, d):
    from episodica.functions.labels import cohort

    labels = table(spark, d, "labels").select(
        split_of(F.col("doc_id")).alias("split"), F.col("doc_id").alias("final_episode_index"), "quality"
    )
    out = donors.attach_provenance(doc_episodes(spark, d).select("split", "episode_index", "goal"), labels)
    source = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return out.withColumn("cohort", cohort(source))


@query(
    "V9_merge_provenance",
    f"""{with_(MERGED)} SELECT split, source_rank, source_episode_index AS episode_index, length, sha256(CAST(conv_id AS VARCHAR)) AS data_json_sha256,
          episode_index AS final_episode_index, first_index AS final_index_start, first_index + length AS final_index_end_exclusive,
          printf('episode_%06d', episode_index) AS split_episode FROM merged_eps""",
    ints="source_rank episode_index length final_episode_index final_index_start final_index_end_exclusive",
)
def provenance(spark, d):
    episodes = turn_episodes(spark, d)
    records = episodes.select(
        "split", "source_rank", "episode_index", F.sha2(F.col("conv_id").cast("string"), 256).alias("data_json_sha256")
    )
    return merge.merge_provenance(episodes.drop("dataset", "conv_id"), records)


@query(
    "V9_provenance_faults",
    f"""{with_(DOCS)} SELECT 'duplicate hash' AS "check", data_json_sha256 AS key FROM docs GROUP BY 2 HAVING count(*) > 1""",
)
def provenance_faults(spark, d):
    return merge.provenance_faults(doc_episodes(spark, d))


@query(
    "J13_verify_merge_order",
    f"""{with_(MERGED)} SELECT split, episode_index AS final_episode_index,
          CASE WHEN source_episode_index % 3 = 1 THEN 'hash' WHEN source_episode_index % 3 = 2 AND length > 5 THEN 'frame count' ELSE 'frame range' END AS fault
        FROM merged_eps WHERE source_episode_index % 3 = 1 OR (source_episode_index % 3 = 2 AND length > 5) OR (source_episode_index % 3 = 0 AND length > 6)""",
    ints="final_episode_index",
)
def merge_order(spark, d):
    """A merged manifest with changed hashes, frame counts and ranges planted in it."""
    episodes = turn_episodes(spark, d)
    digest = F.sha2(F.col("conv_id").cast("string"), 256)
    before = episodes.select(
        "split", "source_rank", F.col("episode_index").alias("order"), digest.alias("data_json_sha256"),
        F.col("length").alias("frame_count"),
    )
    numbered = numbering.renumber_episodes(episodes)
    third = F.pmod("episode_index", F.lit(3))
    merged = numbered.select(
        "split",
        F.col("new_episode_index").alias("final_episode_index"),
        F.when(third == 1, F.sha2(digest, 256)).otherwise(digest).alias("data_json_sha256"),
        F.when((third == 2) & (F.col("length") > 5), F.col("length") + 1).otherwise(F.col("length")).alias("frame_count"),
        F.col("first_index").alias("final_index_start"),
        (F.col("first_index") + F.col("length") + F.when((third == 0) & (F.col("length") > 6), 1).otherwise(0)).alias(
            "final_index_end_exclusive"
        ),
    )
    return merge.verify_merge_order(before, merged)


@query(
    "J14_check_compatible",
    f"""{with_(TURNS)}, i AS (SELECT dataset, source_rank, max(frame_index) AS fps, count(DISTINCT role) AS kinds, max(length(text)) AS widest FROM turns GROUP BY ALL),
        j AS (SELECT a.dataset, unnest([CASE WHEN a.fps <> b.fps THEN 'fps' END, CASE WHEN a.kinds <> b.kinds THEN 'features' END,
          CASE WHEN a.widest <> b.widest THEN 'encoding' END]) AS field FROM i a JOIN i b ON b.source_rank = 0)
        SELECT * FROM j WHERE field IS NOT NULL""",
)
def compatible(spark, d):
    rows = turn_rows(spark, d).withColumn("n", F.length("text"))
    infos = rows.groupBy("dataset", "source_rank").agg(
        F.max("frame_index").alias("fps"), F.count_distinct("role").alias("kinds"), F.max("n").alias("widest")
    )
    fields = {"fps": F.col("fps"), "features": F.col("kinds"), "encoding": F.col("widest")}
    return merge.compatible_differences(infos, F.col("source_rank") == 0, fields)


@query(
    "J17_embedded_prefix_check",
    f"""{with_(DOCS)}, n AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS i,
            count(*) OVER (PARTITION BY split) AS m FROM docs JOIN labels USING (doc_id)),
        rest AS (SELECT d.*, row_number() OVER (PARTITION BY d.split ORDER BY d.doc_id) - 1 AS i FROM docs d WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
        base AS (SELECT split, count(*) AS m FROM n GROUP BY split),
        want AS (SELECT split, i AS episode_index, frame_count AS length FROM n
          UNION ALL SELECT split, i + m, frame_count FROM rest JOIN base USING (split)),
        got AS (SELECT split, episode_index, length + CASE WHEN episode_index % 11 = 0 THEN 1 ELSE 0 END AS length FROM want)
        SELECT 'missing' AS side, split, episode_index, length, 1 AS rows FROM (SELECT * FROM want EXCEPT ALL SELECT * FROM got)
        UNION ALL SELECT 'unexpected', split, episode_index, length, 1 FROM (SELECT * FROM got EXCEPT ALL SELECT * FROM want)""",
    ints="episode_index length rows",
)
def prefix(spark, d):
    docs = doc_episodes(spark, d).select("doc_id", "split", F.col("frame_count").alias("length"))
    labels = table(spark, d, "labels").select("doc_id")

    def numbered(df):
        return row_numbers(df, ["split"], ["doc_id"], index_block("doc_id"), "episode_index", 0).select(
            "split", "episode_index", "length"
        )

    base = numbered(docs.join(labels, "doc_id", "left_semi"))
    incoming = numbered(docs.join(labels, "doc_id", "left_anti"))
    sizes = base.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    moved = incoming.join(sizes, "split").withColumn("episode_index", F.col("episode_index") + F.col("n")).drop("n")
    merged = base.unionByName(moved)
    planted = F.when(F.pmod("episode_index", F.lit(11)) == 0, 1).otherwise(0)
    return merge.embedded_prefix_check(base, incoming, merged.withColumn("length", F.col("length") + planted))


@query(
    "U4_set_equality",
    """WITH a AS (SELECT doc_id FROM documents), b AS (SELECT doc_id FROM labels UNION ALL SELECT page_id + 5000000 FROM pages)
       SELECT 'missing' AS side, doc_id, 1 AS rows FROM a WHERE doc_id NOT IN (SELECT doc_id FROM b)
       UNION ALL SELECT 'unexpected', doc_id, 1 FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)""",
    ints="doc_id rows",
)
def members(spark, d):
    labels = table(spark, d, "labels").select("doc_id")
    pages = table(spark, d, "pages").select((F.col("page_id") + 5000000).alias("doc_id"))
    return merge.set_difference(table(spark, d, "documents").select("doc_id"), labels.unionByName(pages))


@query(
    "J3_episode_coverage",
    """SELECT 'coverage' AS "check", CAST(doc_id AS VARCHAR) AS key, 'no record' AS detail FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def coverage(spark, d):
    return checks.episode_coverage(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query(
    "J10_missing_media",
    """SELECT 'missing file' AS "check", CAST(doc_id AS VARCHAR) AS key, 'doc/' || doc_id AS detail FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang <> 'es'
       UNION ALL SELECT 'no reference', CAST(doc_id AS VARCHAR), NULL FROM documents WHERE lang = 'es'""",
)
def media(spark, d):
    path = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") != "es", path).alias("path"))
    return checks.missing_media(docs, table(spark, d, "labels").select(path.alias("path")), "path", ["doc_id"])


@query(
    "J9_inventory_diff",
    f"""{with_(DOCS)}, new AS (SELECT source_episode AS path, data_json_sha256 AS size FROM docs),
        old AS (SELECT source_episode AS path, CASE toxic WHEN 1 THEN 'old' ELSE data_json_sha256 END AS size FROM docs JOIN labels USING (doc_id)
          UNION ALL SELECT url, 'page' FROM pages)
        SELECT coalesce(n.path, o.path) AS path, CASE WHEN n.path IS NULL THEN 'missing' WHEN o.path IS NULL THEN 'added' ELSE 'changed' END AS state
        FROM new n FULL JOIN old o ON n.path = o.path WHERE n.size IS DISTINCT FROM o.size""",
)
def snapshot_diff(spark, d):
    docs = doc_episodes(spark, d).select("doc_id", F.col("source_episode").alias("path"), F.col("data_json_sha256").alias("size"))
    toxic = F.when(F.col("toxic") == 1, F.lit("old")).otherwise(F.col("size"))
    old = docs.join(table(spark, d, "labels"), "doc_id").select("path", toxic.alias("size"))
    old = old.unionByName(table(spark, d, "pages").select(F.col("url").alias("path"), F.lit("page").alias("size")))
    return checks.inventory_diff(old, docs.select("path", "size"))


@query(
    "V2_validate_tasks",
    """WITH t AS (SELECT source AS dataset, n_chars % 40 AS task_index, CASE lang WHEN 'es' THEN NULL ELSE lang || n_chars % 40 END AS task FROM documents),
         s AS (SELECT dataset, count(*) AS n, min(task_index) AS low, max(task_index) AS high FROM t GROUP BY 1)
       SELECT 'task indices' AS "check", dataset AS key, n || ' in ' || low || '..' || high AS detail FROM s WHERE low <> 0 OR high <> n - 1
       UNION ALL SELECT 'task index repeated', dataset || '/' || task_index, CAST(count(*) AS VARCHAR) FROM t GROUP BY dataset, task_index HAVING count(*) > 1
       UNION ALL SELECT 'task text', dataset || '/' || task_index, 'missing' FROM t WHERE task IS NULL
       UNION ALL SELECT 'task text repeated', dataset || '/' || task, CAST(count(*) AS VARCHAR) FROM t WHERE task IS NOT NULL GROUP BY dataset, task HAVING count(*) > 1""",
)
def task_faults(spark, d):
    docs = table(spark, d, "documents")
    number = F.col("n_chars") % 40
    text = F.when(F.col("lang") != "es", F.concat("lang", number.cast("string")))
    return checks.validate_tasks(
        docs.select(F.col("source").alias("dataset"), number.alias("task_index"), text.alias("task"))
    )


@query(
    "W12_check_contiguous",
    """WITH f AS (SELECT l_orderkey AS e, l_linenumber - 1 AS i FROM lineitem), s AS (SELECT e, count(*) AS n, min(i) AS low, max(i) AS high FROM f GROUP BY e)
       SELECT 'frame_index' AS "check", CAST(e AS VARCHAR) AS key, n || ' rows in ' || low || '..' || high AS detail FROM s WHERE low <> 0 OR high <> n - 1
       UNION ALL SELECT 'frame_index repeated', CAST(e AS VARCHAR), CAST(count(*) AS VARCHAR) FROM
         (SELECT e, i FROM f GROUP BY e, i HAVING count(*) > 1) GROUP BY e""",
)
def contiguous(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("episode_index"), (F.col("l_linenumber") - 1).alias("frame_index")
    )
    return dataset_checks.check_contiguous(lines, ["episode_index"], index=None)


@query(
    "V1_validate_dataset",
    f"""{with_(TURNS)}, i AS (SELECT dataset, split, count(*) AS n, sum(length) AS f FROM eps GROUP BY ALL)
        SELECT 'info' AS "check", dataset || '/' || split AS key, 'total_frames' AS detail FROM i WHERE f % 2 = 1
        UNION ALL SELECT 'coverage', dataset || '/' || split || '/' || episode_index, 'no record' FROM eps WHERE length = 2
        UNION ALL SELECT 'length', dataset || '/' || split || '/' || episode_index, CAST(length AS VARCHAR) FROM eps WHERE length = 6
        UNION ALL SELECT 'info', dataset || '/' || split, 'total_frames' FROM (SELECT dataset, split, any_value(i.f) AS f,
            count(*) FILTER (length = 6) AS extra FROM eps JOIN i USING (dataset, split) GROUP BY ALL) WHERE f % 2 = 0 AND extra > 0""",
)
def dataset_faults(spark, d):
    """Faults planted: odd frame totals, short episodes without stats, six-frame lengths."""
    frames, episodes, tasks = parts(spark, d)
    frames = frames.join(
        numbering.renumber_episodes(episodes.drop("conv_id"), ["dataset", "split"]).select(
            "dataset", "split", "episode_index", "first_index"
        ),
        ["dataset", "split", "episode_index"],
    ).withColumn("index", F.col("first_index") + F.col("frame_index"))
    info = episodes.groupBy("dataset", "split").agg(
        F.count(F.lit(1)).alias("total_episodes"),
        (F.sum("length") + F.pmod(F.sum("length"), F.lit(2)) * 1000000).alias("total_frames"),
    )
    info = info.join(tasks.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("total_tasks")), ["dataset", "split"])
    stats = episodes.where("length <> 2")
    six = F.when(F.col("length") == 6, 7).otherwise(F.col("length"))
    return dataset_checks.validate_dataset(info, tasks, episodes.withColumn("length", six), stats, frames)


@query(
    "V6_validate_stats",
    f"""{with_(EVENTS)}, s AS (SELECT event_type || '_' || split AS feature, count(DISTINCT episode_index) % 3 AS f, stddev_pop(value) AS sd FROM ev GROUP BY ALL)
        SELECT 'statistics' AS "check", feature || '/0' AS key, CASE f WHEN 1 THEN 'negative std' ELSE 'order of min, q01, q99, max' END AS detail FROM s WHERE f > 0
        UNION ALL SELECT 'feature', feature, 'stale fingerprint' FROM s WHERE feature LIKE '%test'""",
)
def stats_faults(spark, d):
    """Real statistics with faults planted by the number of episodes."""
    rows = event_rows(spark, d).select(F.concat_ws("_", "event_type", "split").alias("feature"), "value", "episode_index")
    s = st.episode_stats(rows, "value", ["feature"]).withColumn("dim", F.lit(0))
    people = rows.groupBy("feature", "episode_index").agg(F.lit(1).alias("_one"))
    people = people.groupBy("feature").agg((F.count(F.lit(1)) % 3).alias("f"))
    s = s.join(people, "feature").withColumns(
        {
            "std": F.when(F.col("f") == 1, -F.col("std") - 1).otherwise(F.col("std")),
            "q01": F.when(F.col("f") == 2, F.col("max") + 1).otherwise(F.col("q01")),
            "fingerprint": F.lit("sha256:a"),
        }
    )
    mark = F.when(F.col("feature").endswith("test"), "sha256:b").otherwise("sha256:a")
    expected = s.select("feature", F.lit(1).alias("width"), mark.alias("fingerprint"))
    return checks.validate_stats(s, expected)


@query(
    "V7_validate_calibration",
    f"""{with_(DOCS)}, c AS (SELECT source_dataset AS dataset, split, count(*) AS n, min(doc_id) AS low FROM docs GROUP BY ALL),
        f AS (SELECT dataset, split, low, CASE WHEN n % 3 = 0 THEN NULL ELSE 'sha256:' || sha256('{{"camera":{{"model":"m","serial":"' || dataset || '"}},"n":' || (n % 2) || '}}') END AS fp, n FROM c),
        g AS (SELECT dataset, min(fp) AS a, max(fp) AS b, count(fp) AS tagged, count(*) AS total FROM f GROUP BY dataset)
        SELECT 'several calibrations' AS "check", dataset AS key, b AS detail FROM g WHERE a <> b
        UNION ALL SELECT 'tagged and untagged', dataset, CAST(tagged AS VARCHAR) FROM g WHERE tagged > 0 AND tagged < total
        UNION ALL SELECT 'calibration', dataset || '/' || split, 'full and compact differ' FROM f WHERE fp IS NOT NULL AND low % 2 = 0
        UNION ALL SELECT 'compact without full', dataset || '/' || split, 'sha256:x' FROM f WHERE fp IS NULL AND low % 2 = 0""",
)
def calibrations(spark, d):
    rows = doc_episodes(spark, d).groupBy(F.col("source_dataset").alias("dataset"), "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")
    )
    text = F.format_string('{"n": %d, "camera": {"serial": "%s", "model": "m"}}', F.col("n") % 2, "dataset")
    rows = rows.withColumn("calibration", F.when(F.col("n") % 3 != 0, text))
    rows = rows.withColumns(
        {
            "fingerprint": checks.calibration_fingerprint(F.col("calibration")),
            "compact_fingerprint": F.when(F.col("low") % 2 == 0, "sha256:x"),
        }
    )
    return checks.validate_calibration(rows)


@query(
    "V8_validate_population",
    f"""{with_(TURNS)}, p AS (SELECT CASE dataset WHEN 'base' THEN 'base' WHEN 'left' THEN 'component' ELSE 'final' END AS part, split, count(*) AS e, sum(length) AS f FROM eps GROUP BY ALL),
        s AS (SELECT split, sum(CASE part WHEN 'final' THEN e ELSE -e END) AS e, sum(CASE part WHEN 'final' THEN f ELSE -f END) AS f FROM p GROUP BY split)
        SELECT 'population' AS "check", part || '/' || split AS key, e || '/' || f AS detail FROM p WHERE part <> 'final' AND f % 2 = 1
        UNION ALL SELECT 'population', part || '/' || split, e || '/' || f FROM p WHERE part = 'final'
        UNION ALL SELECT 'final is not base plus component', split, CAST(e AS BIGINT) || '/' || CAST(f AS BIGINT) FROM s WHERE e <> 0 OR f <> 0""",
)
def population(spark, d):
    part = F.when(F.col("dataset") == "left", "component").when(F.col("dataset") == "right", "final").otherwise("base")
    episodes = turn_episodes(spark, d).withColumn("part", part)
    expected = episodes.where("part <> 'final'").groupBy("part", "split").agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("length").alias("frames")
    )
    even = F.col("frames") + F.col("frames") % 2
    return checks.validate_population(episodes, expected.withColumn("frames", even))


@query(
    "V12_schema_fingerprint",
    """SELECT DISTINCT source, lang, 'sha256:' || sha256('{"dtype":"float32","feature":"' || source || '.' || lang || '","shape":[' || length(source) || ']}') AS fingerprint FROM documents""",
)
def fingerprints(spark, d):
    kinds = table(spark, d, "documents").select("source", "lang").distinct()
    name = F.concat_ws(".", "source", "lang")
    return kinds.withColumn(
        "fingerprint", checks.schema_fingerprint(name, F.lit("float32"), F.array(F.length("source")))
    )


@query(
    "V13_required_features",
    f"""{with_(DOCS)}, have AS (SELECT DISTINCT source_dataset, split, goal FROM docs),
        places AS (SELECT DISTINCT source_dataset, split FROM docs)
        SELECT 'feature' AS "check", source_dataset || '/' || split AS key, g AS detail FROM places, (VALUES ('en'), ('de'), ('fr'), ('es')) AS v(g)
          WHERE (source_dataset, split, g) NOT IN (SELECT (source_dataset, split, goal) FROM have)
        UNION ALL SELECT 'robot type', source_dataset, min(split) || ',' || max(split) FROM places GROUP BY source_dataset HAVING min(split) <> max(split)""",
)
def features(spark, d):
    rows = doc_episodes(spark, d).select(
        F.col("source_dataset").alias("dataset"), "split", F.col("goal").alias("feature"), F.col("split").alias("robot_type")
    )
    return checks.required_features(rows, ["en", "de", "fr", "es"])


@query(
    "P10_normalize_split",
    """WITH s AS (SELECT source, CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'validate' WHEN 'fr' THEN 'validation' ELSE 'holdout' END AS split FROM documents)
       SELECT source, split, CASE split WHEN 'validate' THEN 'validation' WHEN 'holdout' THEN NULL ELSE split END AS normalized, count(*) AS episodes FROM s GROUP BY ALL""",
    ints="episodes",
)
def normalized(spark, d):
    from episodica.functions.labels import normalize_split

    return named_splits(spark, d).groupBy("source", "split", normalize_split(F.col("split")).alias("normalized")).agg(
        F.count(F.lit(1)).alias("episodes")
    )


def named_splits(spark, d):
    split = F.when(F.col("lang") == "en", "train").when(F.col("lang") == "de", "validate")
    split = split.when(F.col("lang") == "fr", "validation").otherwise("holdout")
    return table(spark, d, "documents").select("source", split.alias("split"))


@query(
    "P10_split_name_faults",
    """WITH s AS (SELECT source, CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'validate' WHEN 'fr' THEN 'validation' ELSE 'holdout' END AS split FROM documents)
       SELECT 'unknown split' AS "check", source AS key, 'holdout' AS detail FROM s WHERE split = 'holdout' GROUP BY source
       UNION ALL SELECT 'both spellings', source, 'validate,validation' FROM s WHERE split LIKE 'valid%' GROUP BY source HAVING count(DISTINCT split) > 1""",
)
def split_faults(spark, d):
    from episodica.functions.labels import split_name_faults

    return split_name_faults(named_splits(spark, d), root="source")


@query(
    "U2_append_report",
    f"""{with_(MERGED)} SELECT split, count(*) AS total_frames, count(DISTINCT episode_index) AS total_episodes, count(DISTINCT task_index) AS total_tasks,
          avg(size) AS mean, stddev_pop(size) AS std, quantile_cont(size, 0.5) AS q50 FROM merged GROUP BY split""",
    "mean std q50", "total_frames total_episodes total_tasks",
)
def report(spark, d):
    return append_report(*parts(spark, d), value="size").select(
        "split", "total_frames", "total_episodes", "total_tasks", "mean", "std", "q50"
    )
