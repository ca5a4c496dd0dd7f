"""md5 draws of many texts at once: the numbers of ``seeds.draw_below`` without a text per draw.

The texts of a chunk differ in a few digits only. What is the same in all of them goes through
md5 once, as plain numbers: whole blocks, and the first rounds of a block up to the first
word with such digits. Digits come from one table of four-digit texts, not from divisions.
"""

from __future__ import annotations

import math
import struct

import numpy as np

CHUNK = 12288  # draws at once: their words stay in a core's cache
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
ADDED = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
PLACES = [(1, 0), (5, 1), (3, 5), (7, 0)]
ORDER = [(PLACES[i // 16][0] * i + PLACES[i // 16][1]) % 16 for i in range(64)]
# Arrays without dimensions: NumPy converts a number anew in every call.
BITS = [np.array(i, np.uint32) for i in range(33)]
ADDED_ARRAY, ORDER_ARRAY = np.array(ADDED, np.uint32), np.array(ORDER)
DIGITS = 4
WINDOW = 10**DIGITS
MASK = 0xFFFFFFFF


def _plain_rounds(state, words, until: int = 64):
    """md5's registers after the first rounds of a block of numbers."""
    a, b, c, d = state
    for i in range(until):
        kind = i // 16
        mixed = (d ^ (b & (c ^ d)), c ^ (d & (b ^ c)), b ^ c ^ d, c ^ (b | (d ^ MASK)))[kind]
        t, turn = (a + mixed + ADDED[i] + words[ORDER[i]]) & MASK, TURNS[kind][i % 4]
        a, d, c, b = d, c, b, (b + (t << turn | t >> (32 - turn))) & MASK
    return a, b, c, d


# Made where they are used: a function with a cache of its own does not travel to the workers by value.
_blocks, _tables = {}, {}


def _plain_block(state, block: bytes):
    """The state after one block that all texts share."""
    if (state, block) not in _blocks:
        if len(_blocks) >= 4096:
            _blocks.clear()
        after = _plain_rounds(state, struct.unpack("<16I", block))
        _blocks[state, block] = tuple((x + y) & MASK for x, y in zip(state, after, strict=True))
    return _blocks[state, block]


def _block(state, plain, varied, size: int):
    """The state (numbers or arrays) after one block: ``plain`` words, and those that differ added by their place."""
    first = 0
    if not isinstance(state[0], np.ndarray):
        # Word i comes in round i: until the first that differs, all texts agree.
        first = min(varied)
    began = _plain_rounds(state, plain, first) if first else state
    a, b, c, d = [np.full(size, x, np.uint32) if not isinstance(x, np.ndarray) else x.copy() for x in began]
    constants = ADDED_ARRAY + np.array(plain, np.uint32)[ORDER_ARRAY]
    t, u, both = np.empty_like(a), np.empty_like(a), np.empty_like(a)
    xor, and_, or_, not_, add, left, right = np.bitwise_xor, np.bitwise_and, np.bitwise_or, np.invert, np.add, np.left_shift, np.right_shift
    for i in range(first, 64):
        kind = i // 16
        if kind == 0:
            xor(c, d, t)
            and_(t, b, t)
            xor(t, d, t)
        elif kind == 1:
            xor(b, c, t)
            and_(t, d, t)
            xor(t, c, t)
        elif kind == 2:
            # c and d are the b and c of the round before.
            if i % 2 == 0:
                xor(b, c, both)
                xor(both, d, t)
            else:
                xor(both, b, t)
        else:
            not_(d, t)
            or_(t, b, t)
            xor(t, c, t)
        add(t, a, t)
        add(t, constants[i, ...], t)
        word = varied.get(ORDER[i])
        if word is not None:
            add(t, word, t)
        turn = TURNS[kind][i % 4]
        left(t, BITS[turn], u)
        right(t, BITS[32 - turn], t)
        or_(t, u, t)
        add(t, b, a)
        a, d, c, b = d, c, b, a
    for x, y in zip((a, b, c, d), state, strict=True):
        add(x, y if isinstance(y, np.ndarray) else np.array(y, np.uint32), x)
    return a, b, c, d


def _texts() -> np.ndarray:
    """The numbers below ``WINDOW`` as four digits, first digit in the lowest byte."""
    n = np.arange(WINDOW, dtype=np.uint32)
    return sum((48 + n // 10 ** (DIGITS - 1 - i) % 10) << np.uint32(8 * i) for i in range(DIGITS)).astype(np.uint32)


def _digit_words(width: int, offset: int):
    """For all numbers their last ``width`` digits from byte ``offset`` of a word on: that word and the next one, if it has any."""
    if (width, offset) not in _tables:
        texts = _texts() >> np.uint32(8 * (DIGITS - width))
        behind = texts >> np.uint32(8 * (4 - offset)) if offset + width > 4 else None
        _tables[width, offset] = texts << np.uint32(8 * offset), behind
    return _tables[width, offset]


def _fields(position: int, width: int, first: int, last: int):
    """{place of a word: its part of the digits of ``first`` to below ``last``}."""
    words = zip((position // 4, position // 4 + 1), _digit_words(width, position % 4), strict=True)
    return {at: w[first % WINDOW : first % WINDOW + last - first] for at, w in words if w is not None}


def _spans(start: int, end: int):
    """Stretches of numbers from ``start`` to below ``end`` that differ in their last digits only: the rest of the text, count of those digits, first and last number."""
    for width in range(len(str(start)), len(str(max(end - 1, start))) + 1):
        low, high = max(start, 10 ** (width - 1) if width > 1 else 0), min(end, 10**width)
        at = low
        while at < high:
            until = min(high, (at // WINDOW + 1) * WINDOW)
            lead = b"%d:" % width + (b"%d" % (at // WINDOW) if width > DIGITS else b"")
            yield lead, min(width, DIGITS), at, until
            at = until


def digests(text: str, replicates: tuple[int, int], middle: str, start: int, ends: np.ndarray):
    """Chunks (place of the first replicate, draws of it and the following ones, first and second word of their md5).

    The texts are ``text``, the replicate, ``middle`` and each number from ``start`` to below
    the replicate's entry in ``ends``, in the form of ``digest_text``. Draws stand by replicate, then number.
    """
    for lead, wide, first, last in _spans(*replicates):
        own = ends[first - replicates[0] : last - replicates[0]]
        head = text.encode() + lead
        body = head + bytes(wide) + middle.encode()
        for lead_, width, low, high in _spans(start, int(own.max())):
            whole = body + lead_ + bytes(width)
            size = len(whole)
            whole += b"\x80" + bytes((55 - size) % 64) + struct.pack("<Q", 8 * size)
            plain = struct.unpack(f"<{len(whole) // 4}I", whole)
            counts = np.clip(np.minimum(own, high) - low, 0, None)
            numbers = _fields(size - width, width, low, high)
            step = max(1, CHUNK // (high - low))
            for at in range(0, len(own), step):
                count = counts[at : at + step]
                if count.any():
                    of = _fields(len(head), wide, first + at, first + at + len(count))
                    yield first - replicates[0] + at, count, *_words(whole, plain, of, numbers, count)


def _words(whole: bytes, plain, of, numbers, count):
    """First and second word of the md5 of each draw of a chunk."""
    total, state = int(count.sum()), START
    even = bool((count == count[0]).all())
    drawn = {at: np.tile(w[: count[0]], len(count)) if even else np.concatenate([w[:k] for k in count]) for at, w in numbers.items()}
    each = lambda w: np.repeat(w, count)
    whose = False  # whether the state has one entry per replicate
    for at in range(0, len(plain), 16):
        block = range(at, at + 16)
        mine, theirs = {i - at: of[i] for i in block if i in of}, {i - at: drawn[i] for i in block if i in drawn}
        spread = isinstance(state[0], np.ndarray) and not whose
        if not (mine or theirs or isinstance(state[0], np.ndarray)):
            state = _plain_block(state, whole[4 * at : 4 * at + 64])
        elif not theirs and not spread:
            state, whose = _block(state, plain[at : at + 16], mine, len(count)), True
        else:
            if whose:
                state, whose = tuple(each(x) for x in state), False
            for i, w in mine.items():
                theirs[i] = theirs[i] + each(w) if i in theirs else each(w)
            state = _block(state, plain[at : at + 16], theirs, total)
    return state[:2]


def draws(text: str, replicates: tuple[int, int], middle: str, start: int, ends: np.ndarray):
    """``digests`` as chunks (places of the replicates, 60-bit numbers)."""
    for first, count, high, low in digests(text, replicates, middle, start, ends):
        yield np.repeat(np.arange(first, first + len(count)), count), number(high, low)


def number(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """First 60 bits of the md5 with these two words."""
    out = high.byteswap().astype(np.uint64)
    out <<= np.uint64(28)
    out |= low.byteswap() >> np.uint32(4)
    return out


def below(high: np.ndarray, low: np.ndarray, bound: int) -> np.ndarray:
    """``number`` modulo ``bound``."""
    if bound & (bound - 1) == 0 and bound <= 1 << 28:
        rest = low.byteswap()
        rest >>= np.uint32(4)
        rest &= np.uint32(bound - 1)
        return rest.astype(np.int64)
    out = number(high, low)
    # The remainder by a division and a product: both use wide registers.
    whole = out // np.uint64(bound)
    whole *= np.uint64(bound)
    out -= whole
    return out.view(np.int64)
