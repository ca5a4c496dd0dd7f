"""URL rules by a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with
the rule's path. With the labels of a host reversed (``www.example.net`` is ``net.example.www.``)
and the path behind them, all that a rule fits begins with the rule's key: one interval of the
sorted keys. A url has one key for each of its parent hosts, up to the labels of the longest
rule, so a rule's path is compared at the level of the rule's host.

Keys and rules are dealt to ranges by one shuffle. A rule goes to the ranges that its interval
meets: those where it begins, and where it covers the first key (at most one rule for each
prefix of that key). Inside a range the sorted sweep keeps the active rules on a stack; they
are nested, so the top is the longest. Range bounds come from at most ``SAMPLE`` hashed keys
(their first ``HEAD`` characters and a salt, so a key that holds a third of all rows fills
several ranges); they decide where a row is worked on, never the result.

The longest rule wins (host and path together; ties: the longer host). Defined results: a null
url, or one without ``://``, has an empty host and path and fits no rule; a host may hold a
port or user, which are part of its last or first label; rules without a host, or whose path
is neither empty nor begins with ``/``, fit nothing; of rules that share host and path the
verdict last in code-point order holds (block before allow); every row of the table comes back
once, repeated ones too; other columns stay inside ``row`` and cannot clash; an empty table of
pages gives an empty table, one of rules gives the default everywhere.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.tables import located, smallest_hashes

SAMPLE, HEAD = 4096, 64
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    return lowered(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def labels_of(host: Column) -> Column:
    """The host's labels, the last one first."""
    return F.reverse(F.split(host, "[.]", -1))


def key_of(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("."), path)


def keyed_rules(rules: DataFrame) -> DataFrame:
    """key, size of the host, the rule as text and its verdict, one row per rule."""
    whole = rules.select(lowered(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    whole = whole.filter("host != '' AND (path = '' OR startswith(path, '/')) AND verdict IS NOT NULL")
    once = whole.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return once.select(key_of(labels_of(F.col("host")), F.col("path")).alias("key"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict")


def level_keys(parsed: DataFrame, labels: int) -> DataFrame:
    """locator, salt and one key for each host level of a url, at most ``labels``."""
    levels = F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(labels)))
    keys = F.transform(levels, lambda n: key_of(F.slice("labels", 1, n), F.col("path")))
    return parsed.withColumn("labels", labels_of(F.col("host"))).select("locator", F.xxhash64("locator").alias("salt"), F.explode(keys).alias("key"))


def range_bounds(keys: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """At most ``ranges`` - 1 bounds (head of the key, salt) that cut a sample into equal parts."""
    heads = smallest_hashes(keys.select(F.substring("key", 1, HEAD).alias("head"), "salt"), SAMPLE, "head", "salt").collect()
    ordered = sorted((r["head"], r["salt"]) for r in heads)
    return sorted({ordered[len(ordered) * i // ranges] for i in range(1, ranges)}) if ordered else []


def in_ranges(keys: DataFrame, rules: DataFrame, bounds: list[tuple[str, int]]) -> DataFrame:
    """part, key and locator of urls; part, key, host_size, rule and verdict of rules, each in all ranges it meets."""

    def of_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, salts = (batch.column(c).to_pylist() for c in ("head", "salt"))
            part = [bisect_right(bounds, at) for at in zip(heads, salts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column("key"), batch.column("file"), batch.column("row")], names=["part", "key", "file", "row"])

    def of_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key in batch.column("key").to_pylist():
                head = key[:HEAD]
                first = bisect_left(bounds, head, key=lambda b: b[0])
                last = bisect_right(bounds, head, key=lambda b: b[0][: len(head)])
                parts.append(list(range(first, last + 1)))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.list_(pa.int32())), *batch.columns], names=["parts", *batch.schema.names])

    urls = keys.select(F.substring("key", 1, HEAD).alias("head"), "salt", "key", "locator.file", "locator.row")
    urls = urls.mapInArrow(of_urls, "part int, key string, file string, row long")
    spread = rules.mapInArrow(of_rules, "parts array<int>, key string, host_size int, rule string, verdict string")
    return urls.unionByName(spread.select(F.explode("parts").alias("part"), "key", "host_size", "rule", "verdict"), allowMissingColumns=True)


def swept(dealt: DataFrame) -> DataFrame:
    """file, row, size of the rule and of its host, rule and verdict for every key inside a rule's interval."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, active = None, []
        for batch in batches:
            out = []
            for part, key, file, row, host_size, rule, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != at:
                    at, active = part, []
                while active and not key.startswith(active[-1][0]):
                    active.pop()
                if rule is not None:
                    active.append((key, host_size, rule, verdict))
                elif active:
                    top = active[-1]
                    out.append((file, row, len(top[0]), *top[1:]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "row", "size", "host_size", "rule", "verdict"])

    # Rules stand before urls with the same key.
    ordered = dealt.repartition("part").sortWithinPartitions("part", "key", F.col("rule").isNull())
    return ordered.select("part", "key", "file", "row", "host_size", "rule", "verdict").mapInArrow(run, "file string, row long, size int, host_size int, rule string, verdict string")


def judged(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> DataFrame:
    """row (all columns of ``pages``), host, path, rule (host and path as text, null where none fits) and verdict.

    ``rules`` has host, path and verdict; its size is not bounded.
    """
    spark = pages.sparkSession
    url = F.col(f"row.`{url_column}`")
    parsed = located(pages).select("row", "locator", host_of(url).alias("host"), path_of(url).alias("path"))
    ready = keyed_rules(rules)
    labels = rules.agg(F.max(F.size(F.split("host", "[.]", -1)))).first()[0] or 1
    keys = level_keys(parsed, labels)
    bounds = range_bounds(keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = swept(in_ranges(keys, ready, bounds))
    best = found.groupBy("file", "row").agg(F.max_by(F.struct("rule", "verdict"), F.struct("size", "host_size")).alias("best"))
    here = (F.col("locator.file") == F.col("_file")) & (F.col("locator.row") == F.col("_row"))
    joined = parsed.join(best.withColumnsRenamed({"file": "_file", "row": "_row"}), here, "left")
    return joined.select("row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def allowed(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose verdict is ``allow``, with all their columns."""
    return judged(pages, rules, url_column, default).filter("verdict = 'allow'").select("row.*")
