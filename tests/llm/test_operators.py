"""The operators on Spark: odd tables, and plain versions on small ones."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from episodica.llm import exact_dedup, lattice, mixing, near_dedup, repeats, topk, toxicity
from episodica.llm.queries import QUERIES, fold
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, id long, kept boolean, row string, locator string, key string, label int"


def passage(words, seed, alphabet="abcdefghij"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(alphabet) for _ in range(draw.randint(2, 7))) for _ in range(words))


def odd_rows():
    shared = passage(120, 1)
    long = " ".join(passage(400, s) for s in range(60))
    texts = [None, "", "  \n", "one", "One", shared, shared, shared + " tail", "head " + shared, passage(90, 2) + " " + shared + " " + passage(70, 3), long, long + " end", "\U0010fffe é ß"]
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", 1, 7, True, "r", "l", "k", 0) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[6], (None, shared, None, None, None, None, None, None, None, None, None), (None, None, *[None] * 9)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd_rows(), DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(12)] + [(3, 0, 1), (None, 1, 1), (4, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    vectors = [(0, [0.5, 1.0]), (20, [0.5, 1.0]), (40, [-1.0, 0.25]), (1, [0.5, 1.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, []), (7, [0.1]), (20, [0.5, 1.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    pages = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<article><p>A b.</p>" + "<p>word text.</p>" * 3000), (3, "u", "<nav>m</nav>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, odd, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "pages"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


def rows_by_operator(name, spark, folder):
    return QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert rows_by_operator(name, spark, empty) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_top_k", "op9_main_text", "op11_url_rules", "op12_spelling", "op13_phrases"}))
def test_every_row_of_an_odd_table_comes_back(spark, odd, name):
    found = Counter(r["doc_id"] for r in rows_by_operator(name, spark, odd))
    assert found == Counter(r[0] for r in odd_rows())


def test_odd_vectors_and_pages(spark, odd):
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows_by_operator("op3_top_k", spark, odd)}
    assert {q: max(k for p, k in found if p == q) for q, _ in found} == {0: 5, 20: 5, 40: 5}
    assert found[0, 1] == (1, 5120) and found[0, 2] == (20, 5120) and found[40, 5][1] == -1024
    pages = [(r["page_id"], r["text"], r["n_chars"]) for r in rows_by_operator("op9_main_text", spark, odd)]
    assert len(pages) == 5 and (1, "", 0) in pages and (2, "", 0) in pages
    assert any(n == len("A b.") + 3000 * len("\nword text.") for _, _, n in pages)


def test_pipeline_stages_on_an_odd_table(spark, odd, empty, tmp_path):
    columns = [f.split()[0] for f in DOCUMENTS.split(", ")]
    for folder in (odd, empty):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, folder)
            if k < 4:
                assert docs.columns == columns, name
            path = f"{tmp_path}/{k}-{hashlib.md5(folder.encode()).hexdigest()}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if name == "exact dedup":
                texts = [r["text"] or "" for r in docs.select("text").collect()]
                assert len(texts) == len(set(texts))
        assert docs.count() == 0 if folder == empty else docs.count() > 0


def test_pipeline_on_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    final = corpus_pipeline.run(spark, SMALL).select("doc_id", "n_tokens", "decoded_sha256").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert final and all(hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() == r["decoded_sha256"] for r in final)
    kept = {r["doc_id"] for r in final}
    assert len({texts[i] for i in kept}) == len(kept)
    assert max(Counter(r["doc_id"] for r in final).values()) <= mixing.MOST


def test_targets_and_quotas(spark):
    draw = random.Random(1)
    sizes = [draw.choice((0, 3, 40, 900, 5000)) for _ in range(17)]
    weights = [(5, 2, 1)[i % 3] for i in range(17)]
    left, open_, target = float(sum(sizes)), set(range(17)), [0.0] * 17
    while open_:
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / total > 3 * sizes[i]}
        for i in over or open_:
            target[i] = 3.0 * sizes[i] if over else left * weights[i] / total
        left -= sum(target[i] for i in over)
        open_ = open_ - over if over else set()
    table = spark.createDataFrame([(i, sizes[i], weights[i]) for i in range(17)], "source_rank int, source_size long, weight int")
    found = {r["source_rank"]: r["target"] for r in mixing.capped_targets(table).collect()}
    assert [found[i] for i in range(17)] == pytest.approx(target)

    for seats in (0, 1, 7, 100, 1234):
        given = [0] * 17
        for _ in range(seats):
            given[max(range(17), key=lambda i: (sizes[i] / (2 * given[i] + 1), -i))] += 1
        shares = mixing.highest_quotients(table, [], "source_size", F.lit(seats), ["source_rank"], "quota")
        assert {r["source_rank"]: r["quota"] for r in shares.collect()} == dict(enumerate(given))


def test_mixing_comes_near_its_targets(spark):
    rows = QUERIES["op1_mixing"](spark, SMALL)
    found = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] + 32 for r in found)
    again = {tuple(r) for r in QUERIES["op1_mixing"](spark, SMALL).collect()}
    assert again == {tuple(r) for r in rows.repartition(5).collect()} and all(r["taken"] <= 3 * r["size"] for r in rows.collect())


def test_weak_digests_are_told_apart_by_bytes(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    weak = exact_dedup.exact_classes(docs, digest=lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 2, "0")))
    strong = exact_dedup.exact_classes(docs)
    wanted = Counter((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in strong.collect())
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in weak.collect()) == wanted
    assert exact_dedup.drop_exact_copies(docs).count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def near_texts():
    draw = random.Random(9)
    texts = [passage(draw.randint(1, 60), i) for i in range(40)]
    chain = passage(100, 50).split()
    for i in range(40):
        # A chain: neighbours are near, the ends are not.
        texts.append(" ".join([f"w{k}x" for k in range(3 * i)] + chain[3 * i :]))
    for i in range(60):
        words = passage(80, 51).split()
        for _ in range(draw.randint(0, 14)):
            words[draw.randrange(80)] = f"n{i}"
        texts.append(" ".join(words))
    return texts + texts[:5] + ["", None, "solo"]


def test_near_classes_against_all_pairs(spark):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for words, percent in ((2, 80), (5, 80), (1, 60)):
        sets = []
        for t in texts:
            w = (t or "").split()
            sets.append(frozenset(zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else frozenset([tuple(w)] if w else ()))
        root = list(range(len(texts)))

        def top(i, root=root):
            while root[i] != i:
                i = root[i]
            return i

        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    x, y = sorted((top(i), top(j)))
                    root[y] = x
        found = near_dedup.near_classes(docs, words, percent / 100, *((40, 6) if percent == 80 else (80, 3))).collect()
        assert {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == {i: (len(s), top(i), top(i) == i) for i, s in enumerate(sets)}


def test_links_across_components_of_a_bucket(spark, monkeypatch):
    """All texts in one bucket, compared block by block, with no help from the stars."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 20_000)
    sets = [np.unique(np.random.default_rng(i // 10).integers(0, 1 << 62, 120).astype(np.uint64)[: 120 - i % 10]) for i in range(100)]
    found = near_dedup.super_minhash(sets, 240)
    sketch = (near_dedup.mix(found) & np.uint64(0xFFFF)).astype("<u2")
    rows = [(1, f"{i:03}".encode(), f"{i:03}".encode(), len(s), bytes(sketch[i].tobytes()), [1, i + 5], s.tobytes()) for i, s in enumerate(sets)]
    buckets = spark.createDataFrame(rows, "key long, cls binary, label binary, n long, sketch binary, bands array<bigint>, packed binary")
    links = [(int(r["a"]), int(r["b"])) for r in near_dedup.across(buckets, 0.8).collect()]
    labels = {int(r["node"]): int(r["label"]) for r in near_dedup.components(near_dedup.across(buckets, 0.8)).collect()}
    assert labels == {i: i // 10 * 10 for i in range(100)} and len(links) < 400


def test_repeats_against_every_window(spark):
    draw, length = random.Random(3), 40
    shared = [passage(n, 70 + n, "ab") for n in (12, 15, 30)]
    texts = [passage(20, i) for i in range(20)] + [passage(draw.randint(0, 9), 200 + i, "ab") + draw.choice(shared) + passage(draw.randint(0, 9), 300 + i, "ab") for i in range(60)]
    texts += ["ab" * 60, "x" * 90, "x" * 30, texts[3], texts[3], "", None, "é" * 50 + shared[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[s : s + length] for r in raws for s in range(len(r) - length + 1))
    wanted = {}
    for i, r in enumerate(raws):
        gone = [False] * len(r)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        wanted[i] = (len(r), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), kept, hashlib.sha256(kept).hexdigest())
    for group in (20_000, 8, 2):
        found = repeats.without_repeats(docs, length=length, gram=8, group=group).collect()
        assert {r["id"]: tuple(r)[1:] for r in found} == wanted


def test_top_k_against_all_pairs(spark):
    draw = np.random.default_rng(2)
    vectors = np.concatenate([draw.normal(size=(150, 8)), np.tile(draw.normal(size=8), (150, 1)), draw.integers(-2, 3, (100, 8)) / 64])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    whole = np.floor(64 * vectors).astype(np.int64)
    scores = whole @ whole.T
    wanted = {}
    for q in range(0, 400, 7):
        for rank, i in enumerate(sorted((i for i in range(400) if i != q), key=lambda i: (-scores[q, i], i))[:5], 1):
            wanted[q, rank] = (i, scores[q, i])
    for pivots, block in ((64, 4096), (5, 16)):
        found = topk.top_k(table, F.col("vec_id") % 7 == 0, 5, pivots=pivots, block=block).collect()
        assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == wanted


def test_toxicity_on_rows_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [(r["score"], labels[r["doc_id"]]) for r in QUERIES["op4_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad)) > 0.75
    docs = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    assert [r["score"] for r in toxicity.scored(docs, None).collect()] == [0.0, 0.0]


def test_base_scores_and_words_outside_the_head(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    words = {i: [*lattice.words_of(t), None] for i, t in docs.items()}
    counts = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, types = sum(counts.values()), len(counts)
    path = __import__("public_tokenizers").path("piece_bpe_32k.model")
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    few, many = ({r["id"]: r for r in lattice.likelihood(table, path, fold(10), head=h).collect()} for h in (3, 100_000))
    for i, ws in words.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ws)
        r = few[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(w in counts for w in ws), total, zlib.crc32(str(i).encode()) % 10 == 0)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(many[i]["score"])
    # The score, summed plainly: pieces are counted twice over the distinct training words.
    with open(path, "rb") as file:
        model = file.read()
    known = [w.decode() for w in counts if w is not None]
    pieces = {}
    for _ in range(2):
        one = lattice.Lattice(model, pieces)
        pieces = dict(zip(one.names, one.expected(known).tolist(), strict=True))
    one = lattice.Lattice(model, pieces)
    ones, twos = (sum(n == k for w, n in counts.items() if w is not None) for k in (1, 2))
    d = ones / (ones + 2 * twos)

    def of(word):
        spelled = d * types * 10 ** one.log10([word.decode()])[0] if word is not None else 0.0
        return math.log10((max(counts[word] - d, 0.0) + spelled) / total)

    for i in list(words)[:25]:
        assert few[i]["score"] == pytest.approx(math.fsum(map(of, words[i])), rel=1e-6)


def test_token_files_hold_all_ids_in_order(spark):
    rows = sorted(QUERIES["op6_token_files"](spark, SMALL).collect(), key=lambda r: r["doc_id"])
    begin = 0
    for r in rows:
        assert r["start"] == begin
        begin += r["n_tokens"]
    assert len(rows) == len({r["doc_id"] for r in rows}) == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_oracles(spark):
    from episodica.llm.queries import ORACLES

    from tests.oracle import compare, connect

    con = connect(SMALL)
    problems = {name: compare(QUERIES[name](spark, SMALL), con, sql) for name, sql in ORACLES.items()}
    assert not {k: v for k, v in problems.items() if v}, defaultdict(list, problems)
