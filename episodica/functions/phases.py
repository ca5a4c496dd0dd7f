"""Donor frames by episode phase or offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Interventions and their rules.
PHASES = ("phase_matched", "out_of_phase")
OFFSETS = {"offset_10pct": 0.10, "offset_50pct": 0.50}
CURRENT_FRAME = {
    "zero_geometry": "all_zeros",
    "zero_image": "all_zeros",
    "brightness_scale": "same_frame_brightness_scale",
}
ROUNDING_RULE = "floor(uint8_pixel * scale + 0.5), then clip to [0, 255] and cast to uint8"


def progress(frame: Column, length: Column) -> Column:
    return F.when(length > 1, frame / F.nullif(length - 1, F.lit(0))).otherwise(F.lit(0.0))


def phase_progress(frame: Column, length: Column, phase: str) -> Column:
    """Normalized progress, moved by half an episode when out of phase."""
    matched = progress(frame, length)
    return F.pmod(matched + 0.5, F.lit(1.0)) if phase == "out_of_phase" else matched


def phase_frame(frame: Column, length: Column, donor_length: Column, phase: str) -> Column:
    """The donor's frame at that progress, half-even rounded and clamped."""
    at = F.rint(phase_progress(frame, length, phase) * (donor_length - 1)).cast("long")
    return F.greatest(F.least(at, (donor_length - 1).cast("long")), F.lit(0).cast("long"))


def offset_frame(frame: Column, length: Column, fraction: float) -> Column:
    """The same episode's frame after a circular shift of a fraction of it."""
    shift = F.rint(F.lit(fraction) * length).cast("long")
    return F.pmod(frame + shift, length).cast("long")
