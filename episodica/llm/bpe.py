"""Byte-level BPE over rank files, as padded matrices.

A text is split by a pattern; each distinct piece of a batch is encoded once. Pieces of
like length form a padded matrix of token ids. In every round each row merges its leftmost
pair of minimum rank; pairs are looked up in a hash table held in arrays, finished rows
leave, and the holes of merged pairs are squeezed out. Pieces over ``LONG`` bytes, for which
a matrix would take a quadratic number of steps, use the same rule with a heap.

Defined results: null and empty texts have no ids; every other text comes back byte for byte.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.tables import kept_in_worker, slices

LONG = 512
CACHE = 400_000
"""Distinct pieces that a worker remembers."""
NONE = np.int64(1) << 40
MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


class PairTable:
    """Open addressing from a pair of token ids to the id, and so the rank, of their union."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(10, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        key, value = np.array(keys, np.int64), np.array(values, np.int64)
        slot = self._slot(key)
        while len(key):
            # Of the keys that want a free slot, one gets it; the others go on to the next.
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.values[slot[placed]] = value[placed]
            key, value, slot = key[~placed], value[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where they do not merge or either is padding (-1)."""
        out = np.full(left.shape, NONE, np.int64)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left.ravel()[at].astype(np.int64) << 32) | right.ravel()[at]
        slot = self._slot(key)
        while len(at):
            seen = self.keys[slot]
            hit = seen == key
            out.ravel()[at[hit]] = self.values[slot[hit]]
            on = ~hit & (seen != -1)
            at, key, slot = at[on], key[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable(ranks)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Each piece's ids as little-endian 32-bit integers."""
        out: dict[str, bytes] = {}
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[piece] = rank.to_bytes(4, "little")
            elif len(raw) > LONG:
                out[piece] = np.array(self._merge_long(raw), "<u4").tobytes()
            else:
                buckets.setdefault((len(raw) + 3) // 4 if len(raw) <= 32 else 8 + (len(raw) - 1).bit_length(), []).append((piece, raw))
        for bucket in buckets.values():
            width = max(len(raw) for _, raw in bucket)
            rows = max(1, 1_000_000 // width)
            for begin in range(0, len(bucket), rows):
                part = bucket[begin : begin + rows]
                for (piece, _), ids in zip(part, self._merge_rows([raw for _, raw in part], width), strict=True):
                    out[piece] = ids
        return out

    def _merge_rows(self, raws: list[bytes], width: int) -> list[bytes]:
        matrix = np.frombuffer(b"".join(raw.ljust(width, b"\0") for raw in raws), np.uint8).reshape(-1, width)
        sizes = np.array([len(raw) for raw in raws])
        ids = np.where(np.arange(width) < sizes[:, None], self.single[matrix], -1)
        done: list[bytes] = [b""] * len(raws)
        rows = np.arange(len(raws))
        rank = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)
            line = np.arange(len(rows))
            best = rank[line, at]
            over = best == NONE
            if over.any():
                little = ids[over].astype("<u4")
                for row, values, size in zip(rows[over], little, (ids[over] >= 0).sum(axis=1), strict=True):
                    done[row] = values[:size].tobytes()
                ids, rank, rows, at, best = ids[~over], rank[~over], rows[~over], at[~over], best[~over]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            # The merged id goes to the left place; everything after the right place moves one up.
            ids[line, at] = best
            columns = np.arange(ids.shape[1] - 1)
            shifted = columns[None, :] > at[:, None]
            ids = np.concatenate([np.where(shifted, ids[:, 1:], ids[:, :-1]), np.full((len(ids), 1), -1)], axis=1)
            filled = int((ids >= 0).sum(axis=1).max())
            rank = np.concatenate([np.where(shifted[:, :-1], rank[:, 1:], rank[:, :-1]), np.full((len(ids), 1), NONE)], axis=1)
            # Only the two pairs that hold the new token have new ranks.
            before = np.maximum(at - 1, 0)
            rank[line, before] = self.pairs.ranks(ids[line, before], ids[line, before + 1])
            right = np.minimum(at + 1, ids.shape[1] - 1)
            after = np.minimum(at, rank.shape[1] - 1)
            rank[line, after] = self.pairs.ranks(ids[line, after], ids[line, np.maximum(right, after + 1) if ids.shape[1] > 1 else right])
            ids, rank = ids[:, : max(filled, 2)], rank[:, : max(filled, 2) - 1]
        return done

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same merges for one long piece, with a heap of pairs and linked neighbours."""
        ids = [int(self.single[b]) for b in raw]
        get, end = self.ranks.get, len(ids)
        spans = [raw[i : i + 1] for i in range(end)]
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))

        def pair(i: int):
            rank = get(spans[i] + spans[after[i]])
            return None if rank is None else (rank, i, spans[i], spans[after[i]])

        heap = [p for i in range(end - 1) if (p := pair(i))]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            if spans[i] is not left or after[i] >= end or spans[after[i]] is not right:
                continue
            gone = after[i]
            spans[i], spans[gone], ids[i] = left + right, b"", rank
            after[i] = after[gone]
            if after[i] < end:
                before[after[i]] = i
                if p := pair(i):
                    heapq.heappush(heap, p)
            if before[i] >= 0 and (p := pair(before[i])):
                heapq.heappush(heap, p)
        return [ids[i] for i in range(end) if spans[i]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        pieces = set(chain.from_iterable(split))
        found = self.learn(pieces.difference(self.known))
        # The pieces met first, and so the frequent ones, stay; later ones are encoded again.
        if len(self.known) < CACHE:
            self.known.update(found)
            found = self.known
        else:
            found.update((p, self.known[p]) for p in pieces.intersection(self.known))
        return [b"".join(map(found.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4").astype(np.int64)
        sizes = self.lengths[tokens]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[tokens] - ends + sizes, sizes)].tobytes()


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """id, ids (null unless ``keep_ids``), n_tokens, the digests of the ids and of the decoded bytes, n_bytes."""
    schema = f"id {docs.schema[id_column].dataType.simpleString()}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    with open(ranks_path, "rb") as file:
        lines = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(lines)
    version = hashlib.sha256(lines + pattern.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_in_worker(f"bpe:{version}", lambda: Codec(read_ranks(shared.value), pattern))
        for batch, texts in slices(batches, 1):
            ids = codec.encode(texts)
            decoded = [codec.decode(i) for i in ids]
            lists = pa.array([np.frombuffer(i, "<i4") if keep_ids else None for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    lists,
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                    pa.array([len(d) for d in decoded], pa.int64()),
                ],
                names=["id", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
            )

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, schema)
