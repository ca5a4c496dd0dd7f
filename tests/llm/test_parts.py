"""The parts that run inside tasks, against plain versions."""

import base64
import itertools
import math
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from episodica.llm import labelled_pages, main_text
from episodica.llm.bpe import Codec, read_ranks
from episodica.llm.dom import parse
from episodica.llm.lattice import MARK, Lattice
from episodica.llm.near_dedup import band_keys, super_minhash
from episodica.llm.repeats import anchors, long_anchors, sliding_minimum
from episodica.llm.shingles import Polynomial, shingle_sets
from episodica.llm.suffix_sort import common, deep_shallow, furthest, reaches
from episodica.llm.token_files import WordEncoder
from episodica.llm.toxicity import Scores, segment_law
from tokenizers import Tokenizer

ODD = ["", " ", "a", "The the THE", "x's 'S we'll", "日本語 テスト", "é́ ÿ. ﬁ µ", "\x00\x1c\x85 　", "1234 5,6", "zz" * 700, "!?" * 300, " " * 900 + "x", "abc" * 400]


def mixed_texts(n, seed=1):
    draw = random.Random(seed)
    bits = ["a", "b", "ab", "the", " ", "  ", "\n", "'s", "é", "日本", "9", "!!", "\t", "zz", "ing", "The"]
    return ODD + ["".join(draw.choice(bits) for _ in range(draw.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        lines = file.read()
    ranks = read_ranks(lines)
    assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return Codec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_comes_back(codec):
    mine, library = codec
    texts = mixed_texts(300)
    ids = mine.encode(texts)
    assert ids == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert [mine.decode(i) for i in ids] == [t.encode() for t in texts]


def test_bpe_of_long_pieces(codec):
    mine, library = codec
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcdefgh") for _ in range(n)) for n in (511, 512, 513, 3000)] + ["é" * 2000]
    assert mine.encode(texts) == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_word_encoder_equals_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path) as file:
        mine = WordEncoder(file.read())
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = mixed_texts(300) + ["a b. c, <|endoftext|> ΑΣ İ", "x.y,z!?"]
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        ids, sizes = mine.encode(texts)
        assert sizes.tolist() == [len(i) for i in theirs] and ids.tolist() == [x for i in theirs for x in i]
    assert mine.encode([])[0].size == 0 and mine.encode(["", " "])[1].tolist() == [0, 0]


def test_shingles_follow_the_words():
    texts = ["A b c", "a  B\tc", "c b a", "one", "ONE", "", " \n", "x y", "x y x y x y"]
    sets = shingle_sets(texts, 2, Polynomial())
    assert [len(s) for s in sets] == [2, 2, 2, 1, 1, 0, 0, 1, 2]
    assert (sets[0] == sets[1]).all() and (sets[3] == sets[4]).all() and not np.intersect1d(sets[0], sets[2]).size


def test_super_minhash_estimates_similarity():
    draw = np.random.default_rng(5)
    pool = draw.integers(0, 1 << 63, 900).astype(np.uint64)
    sets = [np.unique(pool[:500]), np.unique(pool[100:600]), np.unique(pool[:5]), np.unique(pool[:5]), np.zeros(0, np.uint64), pool[:1]]
    found = super_minhash(sets, 240)
    assert abs((found[0] == found[1]).mean() - 400 / 600) < 0.12
    assert (found[2] == found[3]).all() and (band_keys(found, 40, 6)[2] == band_keys(found, 40, 6)[3]).all()
    assert (found[4] == np.iinfo(np.uint64).max).all() and len(set(found[5].tolist())) == 240
    assert (super_minhash(sets[:1], 240) == found[:1]).all()


def test_deep_shallow_sorts():
    draw = random.Random(2)
    shared = bytes(draw.choice(b"ab") for _ in range(300))
    strings = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 30))) for _ in range(200)]
    strings += [shared[: draw.randint(60, 300)] + bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(200)]
    assert [strings[i] for i in deep_shallow(strings)] == sorted(strings)


def test_reaches_finds_the_furthest_partners():
    draw = random.Random(4)
    for _ in range(60):
        n = draw.randint(2, 25)
        left = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) for _ in range(n)]
        right = [bytes(draw.choice(b"ab") for _ in range(draw.randint(4, 12))) for _ in range(n)]
        for length in (5, 8):
            good = [[(common(left[i], left[j]), common(right[i], right[j])) for j in range(n) if j != i] for i in range(n)]
            good = [[x for x in g if sum(x) >= length] for g in good]
            wanted = [(max((a for a, _ in g), default=-1), max((b for _, b in g), default=-1)) for g in good]
            assert list(zip(furthest(left, right, length), furthest(right, left, length), strict=True)) == wanted
            assert reaches(left, right, length) == [(max(a, 0), max(b, 0)) for a, b in wanted]


def test_anchors_stand_in_every_string_at_the_same_offset():
    values = np.random.default_rng(1).integers(0, 50, 500).astype(np.uint64)
    assert (sliding_minimum(values, 7) == [values[i : i + 7].min() for i in range(494)]).all()
    draw = random.Random(6)
    passage = bytes(draw.randint(97, 122) for _ in range(60))
    texts = [bytes(draw.randint(97, 122) for _ in range(n)) + passage + b"." * n for n in (0, 13, 41)] + [b"short"]
    found = anchors(texts, 50, 8, Polynomial())
    inside = []
    for n, (places, grams) in zip((0, 13, 41), found, strict=False):
        inside.append([(p - n, g) for p, g in zip(places.tolist(), grams.tolist(), strict=True) if 0 <= p - n <= 52])
        assert all(any(s <= p <= s + 42 for p in places) for s in range(len(texts[0]) - 50))
    assert inside[0] and set(inside[0]) & set(inside[1]) & set(inside[2]) and not len(found[3][0])
    whole = long_anchors(texts[2], 50, 8, Polynomial())
    assert whole[0].tolist() == found[2][0].tolist()


def test_lattice_sums_all_segmentations():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        lattice = Lattice(file.read(), {})

    def by_hand(text):
        total = 0.0
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            parts, begin = [], 0
            for i, cut in enumerate([*cuts, 1], 1):
                if cut:
                    parts.append(text[begin:i])
                    begin = i
            total += math.prod(lattice.weight.get(p, 0.0) for p in parts)
        return math.log10(total * lattice.stop)

    words = ["a", "the", "thanedble", "in,", "a", ""]
    assert lattice.log10(words).tolist() == pytest.approx([by_hand(MARK + w) for w in words])
    odd, plain, long = lattice.log10(["\U0010fffe", "a", "x" * 5000])
    assert odd < plain and math.isfinite(odd) and math.isfinite(long)
    assert lattice.log10([]).size == 0


def test_expected_pieces_cover_every_word():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        lattice = Lattice(file.read(), {})
    sizes = np.array([len(p) for p in lattice.names])
    draw = random.Random(2)
    # Words far beyond the floating range count as well.
    for word in ("the", "a" * 400, "".join(draw.choice("abcdefgh") for _ in range(1000)), "thanedble"):
        assert lattice.expected([word]) @ sizes == pytest.approx(len(MARK + word))
    words = ["the", "of", "the", "then", "x" * 30]
    assert lattice.expected(words) == pytest.approx(sum(lattice.expected([w]) for w in words))
    # Characters that are no piece go by their bytes.
    assert lattice.expected(["a\U0010fffeb"]) @ sizes == pytest.approx(len(MARK + "ab"))


def texts_of_page(html):
    return [n.text for n in parse(html) if n.tag == "#"]


def test_pages_keep_all_text_but_raw_elements():
    assert texts_of_page("<article><p>one</p><button>go<p>two</p><p>three</p></article>") == ["one", "go", "two", "three"]
    assert texts_of_page("<p>area is <math><mi>x</mi>+1</math> big</p>") == ["area is x+1 big"]
    assert texts_of_page("<p>a<script>b<p>c</script>d<style>e</style><title>f</title>g<textarea>h") == ["adg"]
    assert texts_of_page("<p>a<script>b<p>c") == ["a"]
    assert texts_of_page("<select><option>a<option>b<p>c</select>d") == ["a", "b", "c", "d"]
    assert texts_of_page("<div>a<svg/>b<svg><text>c</text><div>d</div></svg>e<noscript>f</noscript><iframe>g") == ["a", "b", "c", "d", "e", "f", "g"]
    parents = {n.text: n.parent for n in parse("<article><p>one</p><button>go<p>two</p></article>") if n.tag == "#"}
    nodes = parse("<article><p>one</p><button>go<p>two</p></article>")
    assert nodes[nodes[parents["two"]].parent].tag == "article"


def test_deep_and_stray_markup_takes_linear_time():
    def seconds(n):
        began = time.process_time()
        nodes = parse("<div>" * n + "x" + "</section></li></p>" * n + "<li>y" * n)
        assert len(nodes) > n
        return time.process_time() - began

    seconds(1000)
    assert seconds(16_000) < 40 * max(seconds(2000), 0.01)


def test_segments_are_the_maximal_ones():
    scores = Scores({"good": (2.0, 9.0), "bad": (-1.5, -9.0)}, -0.5, 1.0)
    draw = random.Random(8)
    for _ in range(100):
        words = [draw.choice(("good", "bad", "so")) for _ in range(draw.randint(0, 25))]
        value = {"good": 2.0, "bad": -1.5, "so": -0.5}
        sums = [0.0, *itertools.accumulate(value[w] for w in words)]
        found, n = scores.segments(" ".join(words))
        assert n == len(words)
        best = max((sums[b] - sums[a] for a in range(n + 1) for b in range(a + 1, n + 1)), default=0)
        assert max((s for _, _, s in found), default=0) == pytest.approx(max(best, 0))
        assert all(s == pytest.approx(sums[b] - sums[a]) and s > 0 for a, b, s in found)
        # Every positive word lies in a segment, and segments do not touch in order of gain.
        assert sum(words[a:b].count("good") for a, b, _ in found) == words.count("good")
    assert segment_law({2.0: 1, None: 99})["scale"] > 0


def test_page_model_on_layouts_it_has_not_seen():
    counts = main_text.Counter()
    for page in labelled_pages.labelled_pages():
        nodes = parse(page)
        main_text.count(nodes, main_text.labels_by_hand(nodes), counts)
    model, right, wrong = main_text.Model(counts), 0, 0
    for page in labelled_pages.labelled_pages(150, seed=31):
        nodes = parse(page)
        for node, label, p in zip(nodes, main_text.labels_by_hand(nodes), model.marginals(nodes), strict=True):
            if node.tag == "#":
                right, wrong = right + (bool(label) == (p >= 0.5)), wrong + (bool(label) != (p >= 0.5))
    assert wrong / (right + wrong) < 0.06


def test_marginals_are_exact():
    counts = main_text.Counter()
    for page in labelled_pages.labelled_pages(40):
        nodes = parse(page)
        main_text.count(nodes, main_text.labels_by_hand(nodes), counts)
    model = main_text.Model(counts)
    nodes = parse("<div class=ad><p>Buy now</p></div><article><h1>T</h1><p>Some text here.<p>x</article>")
    total, on = 0.0, [0.0] * len(nodes)
    for states in itertools.product((0, 1), repeat=len(nodes)):
        weight = 1.0
        for node, y in zip(nodes, states, strict=True):
            for e in main_text.evidence(node):
                weight *= model.own.get(e, (1, 1))[y]
            if node.parent >= 0:
                weight *= model.edge.get(node.tag, model.other)[2 * states[node.parent] + y]
        total += weight
        on = [o + weight * y for o, y in zip(on, states, strict=True)]
    assert model.marginals(nodes) == pytest.approx([o / total for o in on])


def test_broken_markup():
    def runs(html):
        return [n.text for n in parse(html) if n.tag == "#"]

    assert runs("<p>a &amp b<br>c<p>d &am<ul><li>e<script>var t='</p>'</script>f</ul>g <b") == ["a & b c", "d &am", "ef", "g"]
    assert runs("<div title='<p>'>x > y < z</div><!-- <p>no</p> -->") == ["x > y < z"]
    assert runs("") == runs("<p>") == runs("<script>x") == []
