"""Sums over all segmentations of many words at once.

Words of one length stand in a matrix of characters. Every run of characters has a number,
made from that of the run without its last one, a hash table of arrays finds the pieces among them, and forward and backward
sums go one position at a time for all words together, in logs: no word is too long or too
unlikely for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from episodica.llm.shingles import BASE, mix, powers

ARCS = 2_000_000
"""Arcs that are held at once; a longer word is taken by itself."""
SLOTS = 19


def characters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)


class Pieces:
    """Numbers of runs of characters, and which piece each is."""

    def __init__(self, pieces: list[str]):
        self.size, self.longest = len(pieces), max(map(len, pieces))
        slots = 1 << max(SLOTS, (4 * len(pieces)).bit_length())
        self.mask = np.uint64(slots - 1)
        self.keys, self.ids = np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)
        self.up = powers(BASE, self.longest + 1)
        self.reach = 1
        numbers = np.zeros(len(pieces), np.uint64)
        for n in {len(p) for p in pieces}:
            places = [i for i, p in enumerate(pieces) if len(p) == n]
            for runs in self.runs(mix(characters([pieces[i] for i in places]).reshape(-1, n).astype(np.uint64))):
                numbers[places] = runs[:, -1]
        for i, number in enumerate(numbers):
            slot, step = int(number & self.mask), 1
            while self.ids[slot] >= 0:
                slot, step = (slot + 1) & int(self.mask), step + 1
            self.keys[slot], self.ids[slot], self.reach = number, i, max(self.reach, step)

    def runs(self, mixed: np.ndarray) -> Iterator[np.ndarray]:
        """For each position the numbers of the runs of 1, 2, ... characters that end there, a column each.

        A run grows by its last character, so each number is made from the one before.
        """
        sums = np.zeros((len(mixed), 0), np.uint64)
        for j in range(mixed.shape[1]):
            width = min(j + 1, self.longest)
            grown = mixed[:, j : j + 1] * self.up[:width]
            grown[:, 1:] += sums[:, : width - 1]
            sums = grown
            yield mix(sums + np.arange(1, width + 1, dtype=np.uint64))

    def find(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these numbers, -1 where there is none."""
        slot = numbers & self.mask
        keys = self.keys[slot]
        found = np.where(keys == numbers, self.ids[slot], np.int32(-1))
        # Few meet another piece's slot and look at the next ones.
        open_ = np.nonzero((keys != numbers) & (keys != 0))
        slot, numbers = slot[open_], numbers[open_]
        more = np.full(len(slot), -1, np.int32)
        for _ in range(self.reach - 1):
            slot = (slot + np.uint64(1)) & self.mask
            more = np.where(self.keys[slot] == numbers, self.ids[slot], more)
        found[open_] = more
        return found


class Segmentations:
    """``logs``: log weight of each piece; ``bytes_``: log weight of each byte, for characters that are no piece."""

    def __init__(self, pieces: Pieces, logs: np.ndarray, bytes_: np.ndarray):
        self.pieces, self.logs, self.bytes = pieces, np.append(logs, -np.inf), bytes_

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of words of one length and their characters."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order])) + 1
        for places in np.split(order, edges) if len(order) else ():
            n = int(size[places[0]])
            step = max(1, ARCS // max(1, n * min(n, self.pieces.longest)))
            for begin in range(0, len(places), step):
                part = places[begin : begin + step]
                yield part, characters([words[i] for i in part.tolist()]).reshape(len(part), n)

    def _spelled(self, text: np.ndarray) -> np.ndarray:
        """Log weight of each character by its bytes where it is no piece, else -inf."""
        kinds, place = np.unique(text, return_inverse=True)
        alone = self.pieces.find(next(self.pieces.runs(mix(kinds.astype(np.uint64))[:, None]))[:, 0]) < 0
        value = [self.bytes[list(chr(c).encode())].sum() if a else -np.inf for c, a in zip(kinds.tolist(), alone.tolist(), strict=True)]
        return np.array(value)[place.reshape(text.shape)]

    def _arcs(self, text: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For each end the ids of runs of 1, 2, ... characters up to it (a column each), and the characters by their bytes."""
        return [self.pieces.find(numbers) for numbers in self.pieces.runs(mix(text.astype(np.uint64)))], self._spelled(text)

    def _forward(self, ends: list[np.ndarray], spelled: np.ndarray) -> np.ndarray:
        """alpha[:, j]: log sum of all segmentations of the first j characters."""
        alpha = np.full((spelled.shape[0], spelled.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j, ids in enumerate(ends, 1):
            terms = self.logs[ids] + alpha[:, j - 1 :: -1][:, : ids.shape[1]]
            terms[:, 0] = np.maximum(terms[:, 0], spelled[:, j - 1] + alpha[:, j - 1])
            top = terms.max(axis=1)
            alpha[:, j] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
        return alpha

    def log_sums(self, words: list[str]) -> np.ndarray:
        """Log weight of each word, summed over all its segmentations."""
        out = np.zeros(len(words))
        for places, text in self._groups(words):
            out[places] = self._forward(*self._arcs(text))[:, -1]
        return out

    def expected(self, words: list[str]) -> np.ndarray:
        """How often each piece stands in a word's segmentations, expected, added up over all words."""
        out = np.zeros(self.pieces.size + 1)
        for _, text in self._groups(words):
            ends, spelled = self._arcs(text)
            alpha = self._forward(ends, spelled)
            n = text.shape[1]
            # beta[:, i]: log sum of all segmentations behind the first i characters.
            beta = np.full((len(text), n + 1), -np.inf)
            beta[:, n] = 0.0
            for j in range(n, 0, -1):
                ids = ends[j - 1]
                width = ids.shape[1]
                arcs = self.logs[ids] + beta[:, j : j + 1]
                begins = slice(j - width, j)
                share = arcs + alpha[:, j - 1 :: -1][:, :width] - alpha[:, n :]
                # What is no piece has weight 0 and is counted behind the last one.
                out += np.bincount(np.where(ids < 0, self.pieces.size, ids).ravel(), np.exp(share).ravel(), self.pieces.size + 1)
                arcs[:, 0] = np.maximum(arcs[:, 0], spelled[:, j - 1] + beta[:, j])
                beta[:, begins] = np.logaddexp(beta[:, begins], arcs[:, ::-1])
        return out[:-1]
