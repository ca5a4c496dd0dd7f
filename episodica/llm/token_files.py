"""Token ids as Parquet list columns, and reading them back.

Rows are written in ascending order of the identifier, one range of identifiers per file.
Row groups and pages are kept small enough that a reader takes one document's ids, or the
metadata columns alone, by the page index; ids are dictionary encoded and, past the
dictionary's size, delta packed (version 2 pages).

A tokenizer that drops white space encodes each word by itself, and most words are cut into
pieces by the same rule as in the tokenizer; a worker encodes distinct pieces, remembers
those it met lately and joins the ids. Documents are put in order before they are encoded.

Defined results: null and empty texts have the end id alone; null identifiers come first,
equal ones in the order of their texts' lengths; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from episodica.llm.shingles import IS_SPACE, chunk_of
from episodica.llm.tables import kept_in_worker, slices

END_ID = 1
CACHE = 200_000
"""Pieces in each of the memo's two halves."""
AT_ONCE = 8192
"""Words given to the tokenizer at once: its results are large objects."""
KEPT = 64
"""Bytes of a piece that is remembered: the memo is bounded in bytes as well."""
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
"""Pieces for which the library's normalizer changes nothing and its pre-tokenizer cuts nothing."""
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of each byte, for words of ASCII and the letters U+00C0 to U+00FF alone.

    In such a word a byte from 0x80 to 0xBF follows 0xC3, so it tells the letter: 0x97 and 0xB7 are
    signs and 0x80 to 0x9E have their lower case 0x20 further. Apostrophes may begin a suffix that is a
    token of its own and ``<`` a special token, so words with them are left whole, as are all others.
    """
    kind, lower = np.full(256, OTHER, np.uint8), np.arange(256, dtype=np.uint8)
    kind[0x21:0x7F] = SIGN
    kind[[ord("'"), ord("<")]] = OTHER
    kind[0x30:0x3A] = DIGIT
    kind[0x41:0x5B] = kind[0x61:0x7B] = kind[0x80:0xC0] = kind[0xC3] = LETTER
    kind[[0x97, 0xB7]] = OTHER
    kind[IS_SPACE] = SPACE
    lower[0x41:0x5B] += 0x20
    lower[0x80:0x9F] += 0x20
    return kind, lower


KIND, LOWER = _tables()


def _byte_characters() -> str:
    """The character that byte-level models have for each byte: itself where it can be printed, else one from U+0100."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in printed else next(rest)) for b in range(256))


CHARACTERS = _byte_characters()
WRITE = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "compression": "zstd",
}


class WordEncoder:
    """Ids of texts by a tokenizer for which words between white space stand alone.

    Where it folds case and parts letters, digits and signs, words of ASCII and the letters of
    Latin-1 are cut into such pieces in arrays, and the library's model encodes each piece; any
    other word is given to the library whole.

    With ``literal`` a special token's text is encoded like other text, else it is that token,
    as by the library's default. Special tokens hold no white space, so both go word by word.
    """

    def __init__(self, definition: str, literal: bool = True):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = literal
        self.model = self.tokenizer.model
        self.cuts = _cuts(json.loads(definition))
        # Pieces met lately, and those met before them.
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        plain = [p for p in pieces if self.cuts and PLAIN.fullmatch(p)]
        tokens = [[t.id for t in self.model.tokenize(p.decode() if p.isascii() else p.decode("latin-1").translate(CHARACTERS))] for p in plain]
        raw = np.fromiter(chain.from_iterable(tokens), "<u4").tobytes()
        ends = list(accumulate((4 * len(t) for t in tokens), initial=0))
        learned = {p: raw[a:b] for p, a, b in zip(plain, ends, ends[1:], strict=False)}
        return learned | self._learn_whole([p for p in pieces if p not in learned])

    def _learn_whole(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encodes words, many in one text; offsets tell whose each id is."""
        learned = {}
        for begin in range(0, len(words), AT_ONCE):
            texts = [w.decode() for w in words[begin : begin + AT_ONCE]]
            groups = [texts[i : i + 64] for i in range(0, len(texts), 64)]
            for group, encoding in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
                ids = np.array(encoding.ids, "<u4")
                starts = np.cumsum([0] + [len(w) + 1 for w in group[:-1]])
                owner = np.searchsorted(starts, np.array([o[0] for o in encoding.offsets], np.int64), "right") - 1
                ends = np.searchsorted(owner, np.arange(len(group)), "right") * 4
                raw, at = ids.tobytes(), 0
                for word, end in zip(group, ends.tolist(), strict=True):
                    learned[word.encode()] = raw[at:end]
                    at = end
        return learned

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text.

        Words and their pieces are told apart in arrays; only distinct pieces of a batch are looked up.
        """
        data, begins = chunk_of(texts)
        kind, letters = self._pieces(data)
        # A piece begins where the kind changes, and each digit is one; white space is between them.
        begin = np.empty(len(kind), bool)
        begin[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=begin[1:])
        begin |= kind == DIGIT
        inside = kind != SPACE
        begin &= inside
        at = np.flatnonzero(begin)
        letters = letters[inside]
        offsets = np.append(np.flatnonzero(begin[inside]), len(letters))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(ids), "<u4")
        pieces = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[pieces]
        before = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(starts[pieces] - before[:-1], lengths)
        source += np.arange(len(source))
        first = np.searchsorted(at, begins)
        return flat[source], before[first[1:]] - before[first[:-1]]

    def _pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The kind of each byte, OTHER for all of a word that is left whole, and the bytes, in lower case where a word is cut."""
        if not self.cuts:
            return np.where(IS_SPACE[data], SPACE, OTHER).astype(np.uint8), data
        kind, letters = KIND[data], LOWER[data]
        other = np.flatnonzero(kind == OTHER)
        if len(other):
            edges = np.flatnonzero(np.diff(kind != SPACE, prepend=False))
            begin, end = edges[::2], edges[1::2]
            words = np.unique(np.searchsorted(begin, other, "right") - 1)
            whole = np.zeros(len(data), np.int8)
            whole[begin[words]], whole[end[words]] = 1, -1
            whole = np.cumsum(whole, dtype=np.int8).view(bool)
            kind[whole] = OTHER
            letters[whole] = data[whole]
        return kind, letters

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        missing = [i for i, f in enumerate(found) if f is None]
        learned = self._learn([p for p in (pieces[i] for i in missing) if p not in old])
        for i in missing:
            piece = pieces[i]
            found[i] = ids = learned[piece] if piece in learned else old[piece]
            # What one batch brings is bounded by the batch.
            if len(piece) <= KEPT:
                young[piece] = ids
        return found


def _cuts(definition: dict) -> bool:
    """Whether the tokenizer folds case, cuts at ``SPLIT`` and has byte-level pieces that go to its model unchanged."""
    steps = [s["type"] for s in (definition["normalizer"] or {}).get("normalizers", [])]
    cut, *levels = (definition["pre_tokenizer"] or {}).get("pretokenizers", [None])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and definition["normalizer"]["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        and cut == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
        and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in levels] == [("ByteLevel", False, False)]
        and all("<" in t["content"] and not t["normalized"] and not t["single_word"] for t in definition["added_tokens"])
    )


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int | None = END_ID, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and ids of every row, the end id last; the text of a special token is that token."""
    with open(tokenizer_path) as file:
        definition = file.read()
    shared, version = docs.sparkSession.sparkContext.broadcast(definition), zlib.crc32(definition.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark runs one task per core; the tokenizer's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = kept_in_worker(f"words:{version}", lambda: WordEncoder(shared.value, literal=False))
        for batch, texts in slices(batches, 1):
            ids, sizes = encoder.encode(texts)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")


def in_file_order(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents dealt to ranges of identifiers and sorted there, before the tokenizer has its turn.

    The bounds of the ranges come from a sample of the rows, which would else be encoded for it.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.repartitionByRange(id_column).sortWithinPartitions(id_column, F.length(text), F.xxhash64(text))


def write_token_files(ids: DataFrame, path: str) -> None:
    """A file for each partition of ``ids``, in its order; n_tokens stands beside the ids for reads without them."""
    ids.withColumn("n_tokens", F.size("ids").cast("long")).write.options(**WRITE).parquet(path)


def token_starts(spark, path: str) -> DataFrame:
    """file, row and start of each document, from the metadata columns alone."""
    meta = spark.read.parquet(path).select("id", "n_tokens", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = meta.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"), F.min(F.struct("id", "file")).alias("first"))
    # One row per file, in the order of their ranges of identifiers.
    order = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("file_start", F.coalesce(F.sum("file_tokens").over(order), F.lit(0))).drop("file_tokens", "first")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    within = meta.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return within.join(files, "file").select("file", "row", (F.col("file_start") + F.col("within")).alias("start"))


def read_token_files(spark, path: str) -> DataFrame:
    """Per document, from the files: id, file, row, n_tokens and the checksum of its ids."""
    rows = spark.read.parquet(path).select("id", "ids", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, ends = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.value_lengths().to_numpy().cumsum()
            begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("file"), batch.column("row"), pa.array(ends - begins, pa.int64()), pa.array(sums, pa.int64())],
                names=["id", "file", "row", "n_tokens", "ids_crc32"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, file string, row long, n_tokens long, ids_crc32 long")
