"""Words cut into pieces in arrays, against the library on whole texts."""

import json
import random

import public_tokenizers
import pytest
from episodica.llm import token_files
from episodica.llm.token_files import WordEncoder
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "aAzZjJ'’s<|>endoftext.,!?-_#$%&*09×÷éÉßÿÀÞðøØŒœ̸́̌\xa0\x85\x1c\x00\x7f \n\t²ªµºİıΣ日"


def odd_texts(n, seed=7):
    draw = random.Random(seed)
    texts = [f"{c} a{c} {c}a B{c}. .{c}! 1{c}2 é{c}É {c}{c}" for c in map(chr, [*range(0x600), *range(0x1E00, 0x2400), 0x3000, 0x1D400, 0x1F600])]
    bits = ["<|endoftext|>", " ", "a", "'s", "'S", "É", "é.", "x'", "$", "<", "5", *LETTERS]
    return texts + ["".join(draw.choice(bits) for _ in range(draw.randint(1, 40))) for _ in range(n)]


def same_as_the_library(definition, literal, texts):
    library, mine = Tokenizer.from_str(definition), WordEncoder(definition, literal)
    library.encode_special_tokens = literal
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        ids, sizes = mine.encode(texts)
        assert sizes.tolist() == [len(i) for i in theirs] and ids.tolist() == [x for i in theirs for x in i]


@pytest.fixture(scope="module")
def definition():
    with open(PATH) as file:
        return file.read()


@pytest.mark.parametrize("literal", [True, False])
def test_every_character_beside_letters_digits_and_signs(definition, literal):
    same_as_the_library(definition, literal, odd_texts(3000))


def test_both_halves_of_the_memo(definition, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 5)
    mine, library = WordEncoder(definition), Tokenizer.from_file(PATH)
    draw = random.Random(2)
    for _ in range(60):
        text = " ".join(draw.choice(["the", "ab,", "Schön", "x9", "é", "it's", "qq" * 40, "no", "yes.", "so"]) for _ in range(6))
        assert mine.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(mine.young) <= 5 + 12 and len(mine.old) <= 5 + 12 and all(len(p) <= token_files.KEPT for p in mine.young)


def test_other_tokenizers_get_whole_words(definition):
    cased = json.loads(definition)
    cased["normalizer"]["normalizers"].pop()
    assert not WordEncoder(json.dumps(cased)).cuts
    same_as_the_library(json.dumps(cased), True, odd_texts(300))


class Counted:
    """A tokenizer that remembers the words it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, []

    def encode_batch(self, texts, **options):
        self.words += [w for t in texts for w in t.split(" ")]
        return self.tokenizer.encode_batch(texts, **options)


def test_only_other_words_take_all_steps_of_the_library(definition):
    mine = WordEncoder(definition)
    mine.tokenizer = Counted(mine.tokenizer)
    mine.encode(["Schön, schön. SCHÖN### (schön) 555-2870 ###", "the The it's Ωmega 2×3"])
    assert sorted(mine.tokenizer.words) == ["2×3", "it's", "Ωmega"]
