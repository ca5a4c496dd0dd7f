"""Texts of special tokens become those tokens, as by the library's default."""

import public_tokenizers
from episodica.llm.token_files import token_ids
from tokenizers import Tokenizer

TEXTS = [
    "a <|endoftext|> b", "a<|endoftext|>b", "A<|ENDOFTEXT|>B", "x. <|endoftext|>. y", "<|endoftext|><|startoftext|>q", "é<|endoftext|>é", "<|endoftext|>́x",
    "<|endoftext|>", "!<|endoftext|>!", "<|endoftext", "ΑΣ<|startoftext|>\n\tİ's<|endoftext|>9", " ".join(["w <|endoftext|>x"] * 100),
]


def test_special_tokens_equal_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r["id"]: r["ids"] for r in token_ids(docs, path).collect()}
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(TEXTS)}
    assert found[0] == [320, 49407, 321, 1]
