"""Seeded draws that depend on keys only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest_text(*parts) -> Column:
    """Parts as one text: each stands with its length, a null as a mark of its own, so that
    different parts never give the same text."""
    text = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def seeded_digest(seed: int, *parts) -> Column:
    """Hex digest of seed and parts; sort by it for a seeded order."""
    return F.md5(digest_text(F.lit(str(seed)), *parts))


def draw(digest: Column) -> Column:
    """63-bit non-negative integer of a digest."""
    high, low = F.conv(F.substring(digest, 1, 15), 16, 10), F.conv(F.substring(digest, 16, 1), 16, 10)
    return high.cast("long") * 8 + F.shiftright(low.cast("int"), 1)


def draw_below(digest: Column, bound: Column) -> Column:
    """A number from 0 to below ``bound``, from the digest's first 60 bits."""
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), bound)


def unit_draw(digest: Column) -> Column:
    """Number in [0, 1)."""
    return draw(digest) / F.lit(float(1 << 63))


def seeded_order(seed: int, *parts) -> Column:
    """A stable 63-bit integer for seed and parts."""
    return draw(seeded_digest(seed, *parts))
