"""Split, manifest and numbering queries over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.catalog.base import DOCS, EVENT_EPISODES, EVENTS, doc_episodes, event_episodes, table, with_
from episodica.catalog.registry import below_sql, digest_sql, draw_sql, query
from episodica.functions.labels import numbered_name
from episodica.functions.seeds import seeded_digest, seeded_order
from episodica.operators import checks, merge, numbering, splits
from episodica.operators.ordered import hash_block
from episodica.plans.compose import compose_collection

SEED = 42


def digest(*parts: str) -> str:
    return digest_sql(SEED, *parts)


def drawn(*parts: str) -> str:
    return draw_sql(SEED, *parts)


def below(*parts: str) -> str:
    return below_sql(SEED, *parts)


@query(
    "T1_target_sizes",
    f"""{with_(DOCS)}, n AS (SELECT source_dataset, count(*) AS total FROM docs GROUP BY 1),
        s AS (SELECT *, greatest(1, CAST(floor(0.1 * total + 0.5) AS BIGINT)) AS t FROM n)
        SELECT source_dataset, total, total - 2 * t AS train, t AS test, t AS validation FROM s""",
    ints="total train test validation",
)
def sizes(spark, d):
    rows = doc_episodes(spark, d).groupBy("source_dataset").agg(F.count(F.lit(1)).alias("total"))
    return rows.select("source_dataset", "total", *[c.alias(n) for n, c in splits.target_sizes(F.col("total")).items()])


QUOTA = DOCS + """,
goals AS (SELECT source_dataset AS ds, goal, count(*) AS size FROM docs GROUP BY ALL),
tot AS (SELECT ds, sum(size) AS total, greatest(1, CAST(floor(0.1 * sum(size) + 0.5) AS BIGINT)) AS want FROM goals GROUP BY ds),
q1 AS (SELECT ds, goal, size, total, want, CAST(floor(want * size / total) AS BIGINT) AS got, want * size / total - floor(want * size / total) AS part FROM goals JOIN tot USING (ds)),
test AS (SELECT *, got + CASE WHEN row_number() OVER (PARTITION BY ds ORDER BY part DESC, size DESC, goal DESC)
    <= want - sum(got) OVER (PARTITION BY ds) THEN 1 ELSE 0 END AS test FROM q1),
q2 AS (SELECT ds, goal, size, total, want, test, size - test AS cap,
    least(CAST(floor(want * size / total) AS BIGINT), size - test) AS got,
    want * size / total - least(floor(want * size / total), size - test) AS part FROM test),
quota AS (SELECT *, got + CASE WHEN cap > got AND row_number() OVER (PARTITION BY ds ORDER BY (cap > got) DESC, part DESC, size DESC, goal DESC)
    <= want - sum(got) OVER (PARTITION BY ds) THEN 1 ELSE 0 END AS validation FROM q2)"""


@query(
    "T2_allocate_quota",
    f"{with_(QUOTA)} SELECT ds AS source_dataset, goal, size, test, validation FROM quota",
    ints="size test validation",
)
def quotas(spark, d):
    return splits.goal_quotas(doc_episodes(spark, d), by=["source_dataset"])


STRATIFIED = QUOTA + f""",
ranked AS (SELECT docs.*, row_number() OVER (PARTITION BY source_dataset, goal
    ORDER BY {digest('source_dataset', 'goal', 'episode_index')}, episode_index) AS r FROM docs),
assigned AS (SELECT r.* EXCLUDE (split, r), CASE WHEN r.r <= q.test THEN 'test' WHEN r.r <= q.test + q.validation THEN 'validation'
    ELSE 'train' END AS split FROM ranked r JOIN quota q ON q.ds = r.source_dataset AND q.goal = r.goal)"""


@query(
    "T3_split_goal_stratified",
    f"{with_(STRATIFIED)} SELECT source_dataset, goal, episode_index, split FROM assigned",
    ints="episode_index",
)
def stratified(spark, d):
    rows = doc_episodes(spark, d).select("source_dataset", "goal", "episode_index")
    return splits.split_goal_stratified(rows, SEED, by=["source_dataset"])


TRIALS = 20000
TRIAL = DOCS + f""",
names AS (SELECT source_session, row_number() OVER (ORDER BY source_session) - 1 AS number, count(*) OVER () AS n
  FROM (SELECT DISTINCT source_session FROM docs)),
anchor AS (SELECT trial, n, {below("'first'", 'trial')} % n AS a,
    {below("'second'", 'trial')} % (n - 1) AS b0, {below("'third'", 'trial')} % (n - 2) AS c0,
    {below("'turn'", 'trial')} % 6 AS turn
  FROM range({TRIALS}) AS t(trial), (SELECT count(*) AS n FROM names)),
anchor2 AS (SELECT *, (a + 1 + b0) % n AS b FROM anchor),
anchor3 AS (SELECT *, c0 + CASE WHEN c0 >= least(a, b) THEN 1 ELSE 0 END AS c1 FROM anchor2),
anchor4 AS (SELECT *, c1 + CASE WHEN c1 >= greatest(a, b) THEN 1 ELSE 0 END AS c FROM anchor3),
orders3 AS (SELECT * FROM (VALUES (0,'train','test','validation'),(1,'train','validation','test'),(2,'test','train','validation'),
  (3,'test','validation','train'),(4,'validation','train','test'),(5,'validation','test','train')) AS o(turn, s0, s1, s2)),
drawn AS MATERIALIZED (SELECT trial, source_session,
    CASE WHEN number = a THEN s0 WHEN number = b THEN s1 WHEN number = c THEN s2
      WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'test' ELSE 'validation' END AS split
  FROM (SELECT trial, a, b, c, s0, s1, s2, source_session, number,
      {drawn("'session'", 'trial', 'number')} / 9223372036854775808.0 AS u
    FROM anchor4 JOIN orders3 USING (turn), names)),
pairs AS (SELECT source_session, goal, count(*) AS n FROM docs GROUP BY ALL),
cells AS (SELECT trial, goal, CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (d.split = 'train'), 0) AS BIGINT) AS train,
    CAST(coalesce(sum(n) FILTER (d.split = 'test'), 0) AS BIGINT) AS test, CAST(coalesce(sum(n) FILTER (d.split = 'validation'), 0) AS BIGINT) AS validation
  FROM pairs JOIN drawn d USING (source_session) GROUP BY trial, goal),
errors AS (SELECT trial, sum(total) AS total, sum(train) AS train, sum(test) AS test, sum(validation) AS validation,
    avg((abs(train - 0.8 * total) + abs(test - 0.1 * total) + abs(validation - 0.1 * total)) / (2 * total)) AS goal_error
  FROM cells GROUP BY trial),
scores AS MATERIALIZED (SELECT trial, goal_error, (abs(train - (total - 2 * t)) + abs(test - t) + abs(validation - t)) / total AS size_error,
    4.0 * (abs(train - (total - 2 * t)) + abs(test - t) + abs(validation - t)) / total + goal_error AS score
  FROM (SELECT *, greatest(1, CAST(floor(0.1 * total + 0.5) AS BIGINT)) AS t FROM errors))"""


@query(
    "T5_assignment_score",
    f"{with_(TRIAL)} SELECT trial, size_error, goal_error, score FROM scores",
    "size_error goal_error score", "trial",
)
def scores(spark, d):
    return splits.session_trials(doc_episodes(spark, d), SEED, TRIALS)


@query(
    "T4_split_session_grouped",
    f"""{with_(TRIAL)} SELECT source_session, episode_index, d.split FROM docs JOIN drawn d USING (source_session)
        WHERE trial = (SELECT trial FROM scores ORDER BY round(score, 12), trial LIMIT 1)""",
    ints="episode_index",
)
def session_grouped(spark, d):
    rows = doc_episodes(spark, d).select("source_session", "goal", "episode_index")
    return splits.split_session_grouped(rows, SEED, TRIALS).drop("goal")


SAMPLE = DOCS + f""",
marks AS (SELECT episode_index, goal FROM docs UNION ALL SELECT episode_index, source_dataset FROM docs),
drawn AS (SELECT *, row_number() OVER (PARTITION BY goal ORDER BY {digest('goal', 'episode_index')}, episode_index) AS r FROM marks)"""


@query(
    "T6_sample_per_goal",
    f"{with_(SAMPLE)} SELECT episode_index, min(goal) AS goal FROM drawn WHERE r <= 5 GROUP BY episode_index",
    ints="episode_index",
)
def sampled(spark, d):
    docs = doc_episodes(spark, d)
    marks = docs.select("episode_index", "goal").unionByName(
        docs.select("episode_index", F.col("source_dataset").alias("goal"))
    )
    return splits.sample_per_goal(marks, 5, SEED)


@query(
    "T7_first_n",
    f"""{with_(EVENTS, EVENT_EPISODES)} SELECT task, episode_index, length, 'first_10' AS selection FROM (
        SELECT *, row_number() OVER (PARTITION BY task ORDER BY episode_index) AS r FROM ep) WHERE r <= 10""",
    ints="episode_index length",
)
def first(spark, d):
    rows = event_episodes(spark, d).select("task", "episode_index", "length")
    return numbering.first_n(rows, 10, ["task"])


@query(
    "T8_seeded_order",
    f"SELECT doc_id, {drawn('lang', 'doc_id')} AS position FROM documents",
    ints="doc_id position",
)
def ordered(spark, d):
    return table(spark, d, "documents").select("doc_id", seeded_order(SEED, "lang", "doc_id").alias("position"))


@query(
    "A28_duplicate_content",
    f"""{with_(DOCS)}, many AS (SELECT data_json_sha256 AS value, count(*) AS owners, min(source_identity) AS first_owner
          FROM docs GROUP BY 1 HAVING count(*) > 1)
        SELECT 'data_json_sha256' AS kind, value, source_identity AS owner, owners, first_owner
        FROM docs JOIN many ON value = data_json_sha256""",
    ints="owners",
)
def duplicates(spark, d):
    return checks.duplicate_content(doc_episodes(spark, d), ["data_json_sha256"])


@query(
    "A28_duplicate_capture",
    f"""{with_(DOCS)}, r AS (SELECT source_identity, unnest(['data_json_sha256', 'capture_start_utc']) AS kind,
            unnest([data_json_sha256, CASE WHEN goal <> 'es' THEN printf('2024-01-01T%06d', frame_count % 3000) END]) AS value FROM docs),
          many AS (SELECT kind, value, count(*) AS owners, min(source_identity) AS first_owner FROM r WHERE value IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
        SELECT kind, value, source_identity AS owner, owners, first_owner FROM r JOIN many USING (kind, value)""",
    ints="owners",
)
def captures(spark, d):
    """Equal capture starts as well as equal content; episodes without a start own none."""
    begun = F.when(F.col("goal") != "es", F.format_string("2024-01-01T%06d", F.col("frame_count") % 3000))
    return checks.duplicate_content(doc_episodes(spark, d).withColumn("capture_start_utc", begun))


@query(
    "J7_split_leakage",
    f"""{with_(DOCS)}, per AS (SELECT data_json_sha256, count(*) FILTER (split = 'train') AS a,
          count(*) FILTER (split <> 'train') AS b FROM docs GROUP BY 1)
        SELECT data_json_sha256, 'train and held-out' AS leak FROM per WHERE a > 0 AND b > 0
        UNION ALL SELECT data_json_sha256, 'held-out twice' FROM per WHERE b > 1""",
)
def leakage(spark, d):
    return checks.split_leakage(doc_episodes(spark, d))


# The old manifest: labelled documents, some with another hash or frame count.
MANIFEST = DOCS + """,
manifest AS (SELECT source_episode, split, doc_id * 2 AS split_order,
    CASE WHEN quality = 0 THEN sha256(data_json_sha256) ELSE data_json_sha256 END AS old_hash,
    frame_count + toxic AS old_frames FROM docs JOIN labels USING (doc_id))"""


def old_manifest(spark, d):
    docs = doc_episodes(spark, d).join(table(spark, d, "labels"), "doc_id")
    changed = F.when(F.col("quality") == 0, F.sha2("data_json_sha256", 256)).otherwise(F.col("data_json_sha256"))
    return docs.select(
        "source_episode", "split", (F.col("doc_id") * 2).alias("split_order"),
        changed.alias("data_json_sha256"), (F.col("frame_count") + F.col("toxic")).alias("frame_count"),
    )


@query(
    "J8_preserve_assignment",
    f"""{with_(MANIFEST)} SELECT source_episode, CASE WHEN old_hash IS NULL THEN 'missing in manifest' ELSE 'kept' END AS state,
          m.split, m.split_order AS preserved_order,
          CASE WHEN old_hash IS NULL THEN NULL ELSE old_hash <> data_json_sha256 END AS hash_changed,
          CASE WHEN old_hash IS NULL THEN NULL ELSE old_frames <> frame_count END AS frame_count_changed
        FROM docs LEFT JOIN manifest m USING (source_episode)""",
    ints="preserved_order",
)
def preserved(spark, d):
    return merge.preserve_assignment(doc_episodes(spark, d), old_manifest(spark, d))


@query(
    "W16_check_preserved_order",
    f"""{with_(MANIFEST)}, moved AS (SELECT split, source_episode,
            row_number() OVER (PARTITION BY split ORDER BY old_frames, source_episode) AS now,
            row_number() OVER (PARTITION BY split ORDER BY split_order) AS old FROM manifest)
        SELECT 'order' AS "check", split || '/' || source_episode AS key, CAST(now AS VARCHAR) AS detail FROM moved WHERE now <> old""",
)
def kept_order(spark, d):
    manifest = old_manifest(spark, d).withColumnRenamed("split_order", "manifest_order")
    from episodica.operators.ordered import index_block, row_numbers

    current = row_numbers(
        manifest, ["split"], ["frame_count", "source_episode"], index_block("frame_count", 64), "split_number"
    )
    return checks.check_preserved_order(current, manifest)


RANKED = DOCS + """,
ranked AS (SELECT *, CAST(substr(source_dataset, 4) AS BIGINT) AS component_rank FROM docs)"""


def ranked_docs(spark, d):
    return doc_episodes(spark, d).withColumn("component_rank", F.substring("source_dataset", 4, 9).cast("long"))


@query(
    "W11_split_names",
    f"""{with_(RANKED)} SELECT source_identity, split,
          printf('episode_%04d', row_number() OVER (PARTITION BY split ORDER BY component_rank, doc_id)) AS split_episode,
          printf('episode_%04d', row_number() OVER (ORDER BY component_rank, doc_id)) AS flattened_episode FROM ranked""",
)
def named(spark, d):
    return numbering.split_names(ranked_docs(spark, d)).select(
        "source_identity", "split", "split_episode", "flattened_episode"
    )


@query(
    "S11_flatten_sessions",
    f"""{with_(DOCS)}, paths AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN upper(goal) ELSE goal END || '/' || source_session AS session FROM docs)
        SELECT session, source_episode, printf('episode_%04d', row_number() OVER (ORDER BY lower(session), doc_id, session)) AS flattened_episode FROM paths""",
)
def flattened(spark, d):
    goal = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.upper("goal")).otherwise(F.col("goal"))
    rows = doc_episodes(spark, d).select(F.concat_ws("/", goal, "source_session").alias("session"), "source_episode")
    return numbering.flatten_sessions(rows, "session")


@query(
    "W10_append_names",
    f"""{with_(DOCS)}, top AS (SELECT split, max(doc_id) AS n FROM docs JOIN labels USING (doc_id) GROUP BY split)
        SELECT d.split, d.source_episode AS episode, printf('episode_%04d', coalesce(t.n, 0) +
          row_number() OVER (PARTITION BY d.split ORDER BY d.source_episode)) AS new_name
        FROM docs d LEFT JOIN top t USING (split) LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL""",
)
def appended_names(spark, d):
    docs = doc_episodes(spark, d).select("doc_id", "split", F.col("source_episode").alias("episode"))
    labels = table(spark, d, "labels").select("doc_id")
    return numbering.append_names(
        docs.join(labels, "doc_id", "left_semi").drop("doc_id"),
        docs.join(labels, "doc_id", "left_anti").drop("doc_id"),
        by=["split"],
    )


@query(
    "W15_check_component_order",
    f"""{with_(DOCS)}, spans AS (SELECT split, goal, min(doc_id) AS low, max(doc_id) AS high,
          list_position(['en','de','fr'], goal) AS r FROM docs GROUP BY ALL),
        known AS (SELECT *, lag(high) OVER (PARTITION BY split ORDER BY r) AS before FROM spans WHERE r > 0)
        SELECT 'unknown component' AS "check", split || '/' || goal AS key, CAST(low AS VARCHAR) AS detail FROM spans WHERE coalesce(r, 0) = 0
        UNION ALL SELECT 'component order', split || '/' || goal, CAST(low AS VARCHAR) FROM known WHERE before >= low
        UNION ALL SELECT 'component missing', split, CAST(count(*) AS VARCHAR) FROM known GROUP BY split HAVING count(*) < 3""",
)
def component_order(spark, d):
    return checks.check_component_order(
        doc_episodes(spark, d), ["en", "de", "fr"], order="doc_id", component="goal"
    )


@query(
    "V4_validate_source",
    f"""{with_(DOCS)}, actual AS (SELECT source_dataset, count(*) AS e, CAST(sum(frame_count) AS BIGINT) AS f FROM docs GROUP BY 1),
        want AS (SELECT source_dataset, e + CASE WHEN e % 5 = 0 THEN 1 ELSE 0 END AS e, f FROM actual),
        kinds AS (SELECT DISTINCT source_dataset, goal FROM docs)
        SELECT 'totals' AS "check", w.source_dataset AS key, unnest(['missing ' || w.e || ' ' || w.f, 'unexpected ' || a.e || ' ' || a.f]) AS detail
          FROM want w JOIN actual a USING (source_dataset) WHERE w.e <> a.e
        UNION ALL SELECT 'goals', source_dataset, 'unexpected ' || goal FROM kinds WHERE goal NOT IN ('en', 'de', 'fr')
        UNION ALL SELECT 'goals', s.source_dataset, 'missing ' || g.goal FROM (SELECT DISTINCT source_dataset FROM docs) s,
          (VALUES ('en'), ('de'), ('fr')) AS g(goal) WHERE (s.source_dataset, g.goal) NOT IN (SELECT (source_dataset, goal) FROM kinds)
        UNION ALL SELECT 'duplicate hash', data_json_sha256, CAST(count(*) AS VARCHAR) FROM docs GROUP BY data_json_sha256 HAVING count(*) > 1""",
)
def source(spark, d):
    docs = doc_episodes(spark, d)
    actual = docs.groupBy("source_dataset").agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("frame_count").alias("frames")
    )
    off = F.when(F.col("episodes") % 5 == 0, 1).otherwise(0)
    expected = actual.withColumn("episodes", F.col("episodes") + off)
    goals = actual.select("source_dataset", F.explode(F.array(*[F.lit(g) for g in ("en", "de", "fr")])).alias("goal"))
    return checks.validate_source(docs, expected, goals)


@query(
    "V5_validate_split_manifest",
    f"""{with_(DOCS)}, s AS (SELECT source_dataset, count(*) AS n, count(*) FILTER (split = 'train') AS train,
          count(*) FILTER (split = 'test') AS test, count(*) FILTER (split = 'validation') AS validation,
          greatest(1, CAST(floor(0.1 * count(*) + 0.5) AS BIGINT)) AS t FROM docs GROUP BY 1)
        SELECT 'repeated data_json_sha256' AS "check", data_json_sha256 AS key, CAST(count(*) AS VARCHAR) AS detail FROM docs GROUP BY data_json_sha256 HAVING count(*) > 1
        UNION ALL SELECT 'split sizes', source_dataset, CAST(n AS VARCHAR) FROM s WHERE n >= 3 AND (test <> t OR validation <> t OR train <> n - 2 * t)
        UNION ALL SELECT 'component sums', source_dataset, CAST(n AS VARCHAR) FROM s WHERE n % 4 = 0""",
)
def manifest(spark, d):
    docs = doc_episodes(spark, d).withColumn("split_episode", F.col("source_episode"))
    counts = docs.groupBy("source_dataset").agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "test", "validation")],
        F.count(F.lit(1)).alias("n"),
    )
    off = F.when(F.col("n") % 4 == 0, 1).otherwise(0)
    return checks.validate_split_manifest(docs, counts.withColumn("train", F.col("train") + off))


@query(
    "V5_manifest_matches",
    f"""{with_(MANIFEST)} SELECT 'manifest' AS "check", d.split || '/' || source_episode AS key,
          CASE WHEN old_frames IS NULL OR old_frames <> frame_count THEN 'length' ELSE 'goal' END AS detail
        FROM docs d LEFT JOIN manifest m USING (source_episode) WHERE old_frames IS NULL OR old_frames <> frame_count""",
)
def manifest_against_converted(spark, d):
    docs = doc_episodes(spark, d)
    converted = old_manifest(spark, d).select("split", "source_episode", F.col("frame_count").alias("length"))
    converted = converted.join(docs.select("source_episode", "goal"), "source_episode")
    return checks.manifest_matches(docs, converted, ["split", "source_episode"])


@query(
    "T3_compose_collection",
    f"""{with_(STRATIFIED)}, named AS (SELECT *, CAST(substr(source_dataset, 4) AS BIGINT) AS component_rank FROM assigned)
        SELECT source_identity, split, data_json_sha256,
          printf('episode_%04d', row_number() OVER (PARTITION BY split ORDER BY component_rank, doc_id)) AS split_episode,
          printf('episode_%04d', row_number() OVER (ORDER BY component_rank, doc_id)) AS flattened_episode FROM named""",
)
def composed(spark, d):
    plan = compose_collection(ranked_docs(spark, d).drop("split"), SEED)
    return plan.select("source_identity", "split", "data_json_sha256", "split_episode", "flattened_episode")
