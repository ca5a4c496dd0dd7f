"""Deterministic splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.contract import RATIOS
from episodica.functions.seeds import draw_below, seeded_digest, unit_draw
from episodica.operators.ordered import first_rows, hash_block, row_numbers, sorted_numbers
from episodica.shared import sized


def target_sizes(total: Column) -> dict[str, Column]:
    """Split sizes of ``total`` episodes; fewer than three fail the task."""

    def share(name: str) -> Column:
        return F.greatest(F.lit(1), F.floor(total * F.lit(RATIOS[name]) + 0.5).cast("int"))

    test, validation = share("test"), share("validation")
    fits = total - test - validation >= 1
    small_test = F.greatest(F.lit(1), F.floor((total - 1) / 2).cast("int"))
    enough = F.when(total >= 3, total).otherwise(
        F.raise_error(F.lit("at least 3 episodes are required")).cast("long")
    )
    return {
        "train": F.when(fits, enough - test - validation).otherwise(F.lit(1)).cast("long"),
        "test": F.when(fits, test).otherwise(small_test).cast("long"),
        "validation": F.when(fits, validation).otherwise(enough - 1 - small_test).cast("long"),
    }


def allocate_quota(goals: DataFrame, seats: str, capacity: str, size="size", goal="goal", by=(), out="count"):
    """Largest-remainder seats per goal under capacities.

    Greedy seating picks the largest (quota - count, size, goal). The keys of one
    goal fall by 1 per seat, so seats come in layers: every goal with room gets one
    before any gets its next. Full layers are found from the distribution of room,
    and only the last layer is ranked. ``seats`` is a column, constant in ``by``.
    """
    by = list(by)
    group = Window.partitionBy(*by)
    totals = goals.groupBy(*by).agg(F.sum(size).alias("_all"))
    rows = goals.join(totals, by) if by else goals.withColumn("_all", totals.scalar())
    quota = F.col(seats) * F.col(size) / F.col("_all")
    given = F.least(F.floor(quota).cast("long"), F.col(capacity).cast("long"))
    rows = rows.withColumns({"_given": given, "_quota": quota})
    rows = rows.withColumns(
        {"_room": F.col(capacity) - F.col("_given"), "_part": F.col("_quota") - F.col("_given")}
    )
    # How many seats the first k layers take, at every value of room that occurs.
    room = rows.groupBy(*by, "_room").agg(
        F.count(F.lit(1)).alias("_goals"), F.sum("_given").alias("_got"), F.max(seats).alias("_seats")
    )
    ordered = group.orderBy("_room")
    upto = ordered.rowsBetween(Window.unboundedPreceding, -1)
    room = room.withColumns(
        {
            "_left": F.col("_seats") - F.sum("_got").over(group),
            "_more": F.sum("_goals").over(group) - F.coalesce(F.sum("_goals").over(upto), F.lit(0)),
            "_step": F.col("_room") - F.coalesce(F.lag("_room").over(ordered), F.lit(0)),
        }
    )
    room = room.withColumn("_cost", F.col("_step") * F.col("_more"))
    room = room.withColumn("_paid", F.coalesce(F.sum("_cost").over(upto), F.lit(0)))
    layers = F.greatest(
        F.lit(0), F.least(F.col("_step"), F.floor((F.col("_left") - F.col("_paid")) / F.col("_more")))
    ).cast("long")
    full = room.withColumn("_layers", layers).groupBy(*by).agg(
        F.sum("_layers").alias("_layers"),
        (F.max("_left") - F.sum(F.col("_layers") * F.col("_more"))).alias("_last"),
    )
    keep = [*goals.columns]
    if by:
        rows = rows.join(full, by)
    else:
        rows = rows.withColumns(
            {"_layers": full.select("_layers").scalar(), "_last": full.select("_last").scalar()}
        )
    open_ = (F.col("_room") > F.col("_layers")).cast("int")
    order = [open_.desc(), F.col("_part").desc(), F.col(size).desc(), F.col(goal).desc()]
    rows = sorted_numbers(rows, by, order, "_rank")
    extra = F.least(F.col("_room"), F.col("_layers")) + F.when(
        (F.col("_room") > F.col("_layers")) & (F.col("_rank") <= F.col("_last")), 1
    ).otherwise(0)
    return rows.select(*keep, (F.col("_given") + extra).cast("long").alias(out))


def goal_quotas(episodes: DataFrame, goal="goal", by=()) -> DataFrame:
    """Test and validation seats per goal (T1, then T2 twice)."""
    by = list(by)
    sizes = episodes.groupBy(*by, F.col(goal).alias("goal")).agg(F.count(F.lit(1)).alias("size"))
    totals = sizes.groupBy(*by).agg(F.sum("size").alias("_total"))
    wanted = target_sizes(F.col("_total"))
    totals = totals.select(*by, wanted["test"].alias("_test"), wanted["validation"].alias("_validation"))
    if by:
        rows = sizes.join(totals, by)
    else:
        rows = sizes.withColumns(
            {"_test": totals.select("_test").scalar(), "_validation": totals.select("_validation").scalar()}
        )
    rows = allocate_quota(rows, "_test", "size", by=by, out="test")
    rows = rows.withColumn("_left", F.col("size") - F.col("test"))
    rows = allocate_quota(rows, "_validation", "_left", by=by, out="validation")
    return rows.drop("_test", "_validation", "_left")


def split_goal_stratified(episodes: DataFrame, seed: int, goal="goal", episode="episode_index", by=()):
    """In each goal a seeded order; first test, then validation, the rest train."""
    by = list(by)
    quotas = goal_quotas(episodes, goal, by).withColumnRenamed("goal", goal)
    rows = episodes.withColumn("_digest", seeded_digest(seed, *by, goal, episode))
    rows = row_numbers(rows, [*by, goal], ["_digest", episode], hash_block("_digest"), "_rank")
    rank = F.col("_rank")
    split = (
        F.when(rank <= F.col("test"), "test")
        .when(rank <= F.col("test") + F.col("validation"), "validation")
        .otherwise("train")
    )
    joined = rows.join(sized(quotas.select(*by, goal, "test", "validation")), [*by, goal])
    return joined.select(*episodes.columns, split.alias("split"))


def _anchors(seed: int, trial: Column, sessions: Column) -> Column:
    """What a trial draws once: three anchor sessions without repeats and the order of their splits."""

    def pick(name: str, bound: Column) -> Column:
        return draw_below(seeded_digest(seed, F.lit(name), trial), bound)

    drawn = F.struct(
        pick("first", sessions).alias("first"),
        pick("second", sessions - 1).alias("gap"),
        pick("third", sessions - 2).alias("third"),
        pick("turn", F.lit(6)).alias("turn"),
    )

    def spread(x: Column) -> Column:
        second = F.pmod(x["first"] + 1 + x["gap"], sessions)
        third = x["third"] + F.when(x["third"] >= F.least(x["first"], second), 1).otherwise(0)
        third = third + F.when(third >= F.greatest(x["first"], second), 1).otherwise(0)
        return F.struct(trial.alias("trial"), x["first"].alias("first"), second.alias("second"), third.alias("third"), x["turn"].alias("turn"))

    # One element, so that each draw is written out once.
    return F.get(F.transform(F.array(drawn), spread), F.lit(0))


def _trial_split(seed: int, anchors: Column, number: Column) -> Column:
    """Split of session ``number``: the anchors take one split each, the others draw with the ratios."""
    orders = [
        ("train", "test", "validation"), ("train", "validation", "test"),
        ("test", "train", "validation"), ("test", "validation", "train"),
        ("validation", "train", "test"), ("validation", "test", "train"),
    ]

    def anchor(place: int) -> Column:
        return F.get(F.array(*[F.lit(o[place]) for o in orders]), anchors["turn"].cast("int"))

    unit = unit_draw(seeded_digest(seed, F.lit("session"), anchors["trial"], number))
    free = F.get(
        F.transform(
            F.array(unit),
            lambda u: F.when(u < RATIOS["train"], "train").when(u < RATIOS["train"] + RATIOS["test"], "test").otherwise("validation"),
        ),
        F.lit(0),
    )
    return (
        F.when(number == anchors["first"], anchor(0))
        .when(number == anchors["second"], anchor(1))
        .when(number == anchors["third"], anchor(2))
        .otherwise(free)
    )


def assignment_score(counts: DataFrame, goals: DataFrame, keys=("trial",)) -> DataFrame:
    """T5: 4 x size error + mean over goals of half the L1 distance to the ratios.

    ``counts``: ``keys, split, goal, episodes`` of an assignment; ``goals``:
    ``goal, goal_total``. Goals a split lacks count with their full share.
    """
    keys = list(keys)
    by_goal = counts.groupBy(*keys, "goal").agg(
        *[F.sum(F.when(F.col("split") == s, F.col("episodes")).otherwise(0)).alias(s) for s in RATIOS]
    )
    by_goal = by_goal.join(goals, "goal")
    total = F.col("goal_total")
    error = sum((F.abs(F.col(s) - F.lit(r) * total) for s, r in RATIOS.items()), F.lit(0.0))
    scored = by_goal.groupBy(*keys).agg(
        *[F.sum(s).alias(s) for s in RATIOS],
        F.sum("goal_total").alias("_total"),
        F.avg(error / (2 * total)).alias("goal_error"),
    )
    wanted = target_sizes(F.col("_total"))
    size_error = sum((F.abs(F.col(s) - wanted[s]) for s in RATIOS), F.lit(0)) / F.col("_total")
    return scored.select(
        *keys, size_error.alias("size_error"), "goal_error", (4.0 * size_error + F.col("goal_error")).alias("score")
    )


def _numbered_sessions(episodes: DataFrame, session: str) -> DataFrame:
    names = episodes.groupBy(session).agg(F.count(F.lit(1)).alias("_episodes"))
    return sorted_numbers(names, [], [session], "_number", start=0)


def session_trials(episodes: DataFrame, seed: int, trials: int, session="source_session", goal="goal"):
    """T4/T5: the score of every trial.

    Episodes are counted per (session, goal) first. A trial's own draws are made once; it
    then costs one draw per session and one row per (session, goal), summed before the shuffle.
    """
    numbers = _numbered_sessions(episodes, session)
    size = numbers.agg(F.count(F.lit(1)).alias("n"))
    pairs = episodes.groupBy(session, F.col(goal).alias("goal")).agg(F.count(F.lit(1)).alias("episodes"))
    pairs = pairs.groupBy(session).agg(F.collect_list(F.struct("goal", "episodes")).alias("_goals"))
    rows = pairs.join(numbers.select(session, "_number"), session)
    every = episodes.sparkSession.range(trials).select(F.col("id").alias("trial"), size.scalar().alias("n"))
    drawn = every.select(_anchors(seed, F.col("trial"), F.col("n")).alias("a")).agg(F.collect_list("a").alias("all"))
    # One entry per trial, whatever the number of episodes.
    rows = rows.withColumn("_all", drawn.scalar()).select("_number", "_goals", F.explode("_all").alias("_a"))
    rows = rows.select("_goals", F.col("_a.trial").alias("trial"), _trial_split(seed, F.col("_a"), F.col("_number")).alias("split"))
    rows = rows.select("trial", "split", F.explode("_goals").alias("_g"))
    counts = rows.groupBy("trial", F.col("_g.goal").alias("goal"), "split").agg(F.sum("_g.episodes").alias("episodes"))
    goals = episodes.groupBy(F.col(goal).alias("goal")).agg(F.count(F.lit(1)).alias("goal_total"))
    return assignment_score(counts, goals)


def split_session_grouped(
    episodes: DataFrame, seed: int, trials: int = 20000, session="source_session", goal="goal"
) -> DataFrame:
    """T4: whole sessions stay together; the best of many drawn assignments."""
    scores = session_trials(episodes, seed, trials, session, goal)
    # Rounded, so that the order of summation cannot decide between equal scores.
    best = scores.agg(F.min_by("trial", F.struct(F.round("score", 12), "trial")).alias("trial"))
    numbers = _numbered_sessions(episodes, session)
    size = numbers.agg(F.count(F.lit(1)).alias("n"))
    chosen = numbers.withColumns({"_trial": best.scalar(), "_sessions": size.scalar()})
    enough = F.when(F.col("_sessions") >= 3, F.col("_sessions")).otherwise(
        F.raise_error(F.lit("at least 3 sessions are required")).cast("long")
    )
    chosen = chosen.select(
        session, _trial_split(seed, _anchors(seed, F.col("_trial"), enough), F.col("_number")).alias("split")
    )
    return episodes.join(sized(chosen), session)


def sample_per_goal(episode_goals: DataFrame, k: int, seed: int, goal="goal", episode="episode_index"):
    """Up to ``k`` episodes per goal without replacement; an episode drawn for
    several goals appears once."""
    drawn = episode_goals.withColumn("_digest", seeded_digest(seed, goal, episode))
    kept = first_rows(drawn, [goal], ["_digest", episode], hash_block("_digest"), k)
    return kept.groupBy(episode).agg(F.min(goal).alias(goal))
