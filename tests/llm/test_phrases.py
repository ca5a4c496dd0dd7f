"""Phrases against plain counts of all word runs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from episodica.llm import phrases
from episodica.llm.queries import QUERIES
from pyspark.sql import functions as F

SHAPE = "doc_id long, text string, lang string, phrase string, n long, a long, score string"


def plain(rows, longest=3, least=10):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    inside = defaultdict(int)
    candidates = [(lang, p, a) for (lang, p), a in counts.items() if len(p) > 1 and a >= least]
    for lang, p, a in candidates:
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inside[lang, p[i : i + size]] = max(inside[lang, p[i : i + size]], a)
    out = defaultdict(list)
    for lang, p, a in candidates:
        if 100 * inside[lang, p] >= 50 * a:
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], totals[lang]))
    return {(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], r[5], -r[0]) for lang, found in out.items() for i, r in enumerate(sorted(found)[:2000])}


def sentences(seed, count, words=6):
    draw = random.Random(seed)
    some = ["The", "the", "of", "é", "ab", "word", "\U0001f600", "x-y", "a\xa0b"][:words]
    return ["".join(draw.choice(some) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", ";"]) for _ in range(draw.randint(0, 60))) for _ in range(count)]


def tuples(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


@pytest.mark.parametrize(("hot", "pointers", "longest"), [(10_000, 500_000, 3), (1, 500_000, 3), (4, 40, 3), (6, 400, 4), (100, 40, 2), (10_000, 2, 3)])
def test_equals_plain_counts(spark, monkeypatch, hot, pointers, longest):
    monkeypatch.setattr(phrases, "POINTERS", pointers)
    monkeypatch.setattr(phrases, "SHORT", 16)
    monkeypatch.setattr(phrases, "TOGETHER", 3)
    rows = [(t, lang) for seed, lang in enumerate(["en", "de", None, "und"]) for t in sentences(seed, 60, 5 + seed)]
    docs = spark.createDataFrame([(i, t, lang, "p", 1, 1, "s") for i, (t, lang) in enumerate(rows)], SHAPE).repartition(4)
    found = tuples(phrases.best_phrases(phrases.collocations(docs, longest=longest, hot=hot)))
    assert found == plain(rows, longest) and len(found) > 30


def test_odd_documents(spark, tmp_path):
    rows = [(None, None), ("", "en"), (" \t. ,", "en"), ("one two " * 30, None), ("One two. " * 30, "en"), ("x" * 300_000 + " y " + "z" * 300_000, "en"), *[("same text here now", "fr")] * 25, *[("Ab cD ef", "en")] * 10, ("a b c d " * 50_000, "de")]
    spark.createDataFrame([(i, t, lang, "p", 1, 1, "s") for i, (t, lang) in enumerate(rows)], SHAPE).write.parquet(f"{tmp_path}/documents.parquet")
    assert tuples(QUERIES["op13_phrases"](spark, str(tmp_path))) == plain(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    values = [(10**15 - 1, 10**15, 3 * 10**15 + 7), (10**12 + 3, 10**12 + 3, 10**12 + 3), (10, 3, 7)]
    found = spark.createDataFrame(values, "a long, l long, r long").withColumn("score", F.expr(phrases.SCORE)).collect()
    assert [r["score"] for r in found] == [1_000_000 * a * a // (low * high) for a, low, high in values]


def test_partitions_of_quicksort(monkeypatch):
    monkeypatch.setattr(phrases, "SHORT", 4)
    draw = np.random.default_rng(5)
    columns = [draw.integers(-1, 6, 700), draw.integers(-1, 4, 700)]
    columns[1][columns[0] < 0] = -1
    weight = draw.integers(1, 9, 700)
    expected = Counter()
    for a, b, w in zip(*columns, weight, strict=True):
        expected[(a,)] += w * (a >= 0)
        expected[a, b] += w * (a >= 0 and b >= 0)
    for least in (1, 40, 500):
        found = {}
        for depth, pointers, weights in phrases.equal_partitions(columns, weight, least):
            for p, w in zip(pointers, weights, strict=True):
                key = tuple(c[p] for c in columns[:depth])
                assert key not in found
                found[key] = w
        assert found == {k: w for k, w in expected.items() if w >= least and w}
