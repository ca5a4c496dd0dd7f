"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from episodica.llm import spelling
from episodica.llm.queries import QUERIES

SHAPE = "doc_id long, text string, lang string, word string, n long, id string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_variants(vocabulary, ratio=5):
    shorter = {}
    for w in vocabulary:
        for i in range(len(w)):
            shorter.setdefault((len(w), i, w[:i] + w[i + 1 :]), []).append(w)
    close = {w: set() for w in vocabulary}
    for same in shorter.values():
        for w in same:
            close[w].update(x for x in same if x != w)
    for w in vocabulary:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            if cut in vocabulary:
                close[w].add(cut)
                close[cut].add(w)
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best is not None and vocabulary[best] >= ratio * vocabulary[w] else None
    out = set()
    for w in vocabulary:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, vocabulary[w], len(close[w]), None if form[w] is None else vocabulary[form[w]]))
    return out


def random_words(draw, letters, count, longest):
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))) for _ in range(count)}
    for w in list(words)[: count // 2]:
        i = draw.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + draw.choice(letters) + w[i + 1 :], w[:i] + draw.choice(letters) + w[i:]}
    return words


@pytest.mark.parametrize(("letters", "longest", "group"), [("ab", 7, 20_000), ("ab", 9, 6), ("abcdé", 8, 30), ("a", 30, 2), ("abcdefghijklmnop", 12, 50)])
def test_near_words_equal_all_pairs(spark, letters, longest, group):
    draw = random.Random(len(letters) * longest)
    vocabulary = {w: draw.choice([5, 6, 30, 200, 1500]) for w in random_words(draw, letters, 250, longest)}
    table = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    found = {tuple(r) for r in spelling.variants(table, group=group).collect()}
    assert found == plain_variants(vocabulary)


def test_pairs_of_one_scan():
    words = sorted({"abcd", "abce", "abcde", "xabcd", "abd", "bcd", "zzzz", "zzzzz"} - {"abd", "bcd"})
    size = np.array([len(w) for w in words])
    left, right = spelling.near_pairs(np.zeros(len(words), np.int64), words, size == 4)
    assert {(words[a], words[b]) for a, b in zip(left, right, strict=True)} == {(a, b) for a in words for b in words if len(a) == 4 and len(b) >= 4 and near(a, b)}


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in QUERIES["op12_spelling"](spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found)) and set(found) == plain_variants(plain_counts(docs))


def test_odd_documents(spark, tmp_path):
    texts = [None, "", "short words only", "Straße STRASSE straßen " * 7, "ÀÉÎÕÜabc àéîõüabc×÷ " * 6, "abcdefg " * 40 + "abcdefh abcdefgx bcdefg " * 6, "w" * 50_000 + " " + "w" * 49_999, "𝒳abcdefg\u0100abcdefg " * 5]
    rows = [(i if i % 3 else None, t, "en", "w", 1, "i") for i, t in enumerate(texts)]
    rows += [rows[6]] * 9
    spark.createDataFrame(rows, SHAPE).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in QUERIES["op12_spelling"](spark, str(tmp_path)).collect()]
    expected = plain_variants(plain_counts([r[:2] for r in rows]))
    assert len(found) == len(set(found)) and set(found) == expected and any(len(r[0]) > 40_000 and r[4] for r in expected)
