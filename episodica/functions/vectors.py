"""Vector columns: checks, groups, slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.contract import EPISODE, Layout, is_finite


def check_vector(df: DataFrame, column: str, width: int, keys=(*EPISODE, "frame_index")) -> DataFrame:
    """Rows whose vector is null, has null members or not the exact width."""
    vector = F.col(column)
    detail = (
        F.when(vector.isNull(), F.lit("null vector"))
        .when(F.size(vector) != width, F.format_string("width %d", F.size(vector)))
        .when(F.exists(vector, lambda x: x.isNull()), F.lit("null member"))
    )
    return (
        df.withColumn("detail", detail)
        .where(F.col("detail").isNotNull())
        .select(F.lit(f"vector:{column}").alias("check"), *keys, "detail")
    )


def joint_names(features: Column) -> Column:
    """Names of a feature; a list wrapped in one more list is unwrapped.

    ``features`` is the JSON text of ``names``.
    """
    nested = F.from_json(features, "array<array<string>>")
    plain = F.from_json(features, "array<string>")
    wrapped = features.rlike(r"^\s*\[\s*\[")
    return F.when(wrapped, F.flatten(nested)).otherwise(plain)


def joint_name_faults(contracts: DataFrame) -> DataFrame:
    """Faults over rows ``(dataset, feature, names, width)``: duplicates, wrong
    count, order differing between datasets or between action and state."""
    names = F.col("names")
    own = contracts.select(
        "dataset",
        "feature",
        F.when(names.isNull() | (F.size(names) != F.col("width")), F.lit("names do not match width"))
        .when(F.size(F.array_distinct(names)) != F.size(names), F.lit("duplicate names"))
        .alias("detail"),
    ).where(F.col("detail").isNotNull())
    across = (
        contracts.groupBy("feature")
        .agg(F.count_distinct(F.to_json("names")).alias("orders"))
        .where(F.col("orders") > 1)
        .select(
            F.lit(None).cast("string").alias("dataset"),
            "feature",
            F.lit("order differs between datasets").alias("detail"),
        )
    )
    pairs = (
        contracts.where(F.col("feature").isin("action", "observation.state"))
        .groupBy("dataset")
        .agg(F.count_distinct(F.to_json("names")).alias("orders"))
        .where(F.col("orders") > 1)
        .select(
            "dataset",
            F.lit("action").alias("feature"),
            F.lit("order differs from state").alias("detail"),
        )
    )
    return own.unionByName(across).unionByName(pairs)


def explode_joints(df: DataFrame, column: str, names: list[str] | None = None) -> DataFrame:
    """One row per (row, joint): ``joint_index, joint_name, value``."""
    others = [c for c in df.columns if c != column]
    flat = df.select(*others, F.posexplode(column).alias("joint_index", "value"))
    if names is None:
        label = F.format_string("joint_%d", "joint_index")
    else:
        label = F.get(F.array(*[F.lit(n) for n in names]), F.col("joint_index"))
    return flat.withColumn("joint_name", label)


def stack_groups(*vectors: Column) -> Column:
    """Group vectors joined in key order; a non-finite member fails the task."""
    joined = F.concat(*[F.transform(v, lambda x: x.cast("double")) for v in vectors])
    return F.when(F.forall(joined, is_finite), joined).otherwise(
        F.raise_error(F.lit("non-finite vector member")).cast("array<double>")
    )


def slice_modality(vector: Column, layout: Layout) -> dict[str, Column]:
    """P5: the named half-open slices of one vector."""
    return {key: F.slice(vector, start + 1, end - start) for key, start, end in layout}


def joint_groups(joint: Column, layout: Layout) -> Column:
    """Array of the groups a joint belongs to; explode it to fan rows out."""

    def within(pick) -> Column | None:
        tests = [(joint >= s) & (joint < e) for key, s, e in layout if pick(key)]
        if not tests:
            return None
        found = tests[0]
        for test in tests[1:]:
            found = found | test
        return found

    rules = {"all": within(lambda key: True)}
    rules |= {name: within(lambda key, name=name: key == name) for name, _, _ in layout}
    rules |= {
        "arms": within(lambda key: "arm" in key),
        "hands": within(lambda key: "hand" in key),
        "left_side": within(lambda key: key.startswith("left_")),
        "right_side": within(lambda key: key.startswith("right_")),
    }
    members = [F.when(test, F.lit(name)) for name, test in rules.items() if test is not None]
    return F.array_compact(F.array(*members))
