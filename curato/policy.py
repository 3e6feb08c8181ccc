"""Scoring policy: thresholds, weights, variant and null handling as one value."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# These must equal the original scorer's constants for the
# scores to agree.
MIN_RESOLUTION = 160000
MAX_RESOLUTION = 2073600
MIN_ASPECT_RATIO = 0.3
MAX_ASPECT_RATIO = 4.65
MAX_FRESHNESS_DAYS = 3650
WEIGHT_RESOLUTION = 6
WEIGHT_ASPECT_RATIO = 2
WEIGHT_FRESHNESS = 2
WEIGHT_TAG = 3


@dataclass(frozen=True)
class Weights:
    resolution: float = WEIGHT_RESOLUTION
    aspect_ratio: float = WEIGHT_ASPECT_RATIO
    freshness: float = WEIGHT_FRESHNESS
    tag: float = WEIGHT_TAG

    @property
    def total(self) -> float:
        return self.resolution + self.aspect_ratio + self.freshness + self.tag


@dataclass(frozen=True)
class Policy:
    """How images are scored and picked.

    variant        "A": the flagship scorer (``least`` caps, so a null size or
                   date scores 1, an untagged image scores null and ranks last);
                   "B": the alternative scorer (CASE clamps, nulls stay null,
                   missing tag probability counts 0, one candidate per tag).
    as_of          the day freshness is measured from; ``None`` means today.
    score_digits   round the composite score before ranking (parity checks).
    require_active drop images whose active flag is null ("deleted") from the
                   candidates; by default they stay candidates.
    null_as_zero   scorer A: an unknown size or date scores 0 instead of 1.
    legacy_url     pair the new pick with the old pick's url, as the original
                   job did; by default the new image's url is emitted.
    """

    variant: str = "A"
    as_of: _dt.date | None = None
    min_resolution: int = MIN_RESOLUTION
    max_resolution: int = MAX_RESOLUTION
    min_aspect_ratio: float = MIN_ASPECT_RATIO
    max_aspect_ratio: float = MAX_ASPECT_RATIO
    max_freshness_days: int = MAX_FRESHNESS_DAYS
    weights: Weights = field(default_factory=Weights)
    score_digits: int | None = None
    require_active: bool = False
    legacy_url: bool = False
    null_as_zero: bool = False

    def __post_init__(self):
        if self.variant not in ("A", "B"):
            raise ValueError(f"unknown scoring variant {self.variant!r}")
        if self.min_resolution <= 0 or self.max_resolution <= self.min_resolution:
            raise ValueError("resolution bounds must satisfy 0 < min < max")
        if self.null_as_zero and self.variant != "A":
            raise ValueError("null_as_zero belongs to scorer A")
        if self.max_freshness_days <= 0:
            raise ValueError("max_freshness_days must be positive")
