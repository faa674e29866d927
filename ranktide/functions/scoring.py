"""The ICE opportunity score and the click-through benchmark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score tiers by lower bound, and expected click-through in percent by position.
TIERS = ((7.0, "P1 - Critical"), (4.0, "P2 - High"), (2.0, "P3 - Medium"))
LOWEST_TIER = "P4 - Low"
CTR_STEPS = ((1, 28.0), (3, 15.0), (5, 8.0), (10, 4.0))
CTR_BEYOND = 1.5
VOLUME_CEILING = 100000.0


@dataclass(frozen=True)
class Ice:
    """The three parts of the score, unrounded, and what follows from them."""

    impact: Column
    confidence: Column
    ease: Column

    @property
    def score(self) -> Column:
        return self.impact * self.confidence * self.ease / F.lit(100.0)

    @property
    def tier(self) -> Column:
        return tier_of(self.score)


def ice(volume: Column, difficulty: Column, position: Column) -> Ice:
    """Impact grows with the logarithm of the volume, confidence falls with the difficulty, ease with
    the position. Each lies in 1..10."""
    searches = F.greatest(volume.cast("double"), F.lit(1.0))
    impact = F.least(F.lit(10.0), F.lit(1.0) + F.log10(searches) / F.log10(F.lit(VOLUME_CEILING)) * F.lit(9.0))
    confidence = (F.lit(100) - difficulty) / F.lit(100.0) * F.lit(9.0) + F.lit(1.0)
    ease = F.greatest(F.lit(1.0), (F.lit(31) - position) / F.lit(30.0) * F.lit(9.0) + F.lit(1.0))
    known = volume.isNotNull()
    return Ice(F.when(known, impact), confidence, F.when(position.isNotNull(), ease))


def tier_of(score: Column) -> Column:
    """Tier of an unrounded score; the first bound reached wins."""
    (bound, label), *rest = TIERS
    chain = F.when(score >= bound, label)
    for bound, label in rest:
        chain = chain.when(score >= bound, label)
    return chain.otherwise(LOWEST_TIER)


def ctr_benchmark(position: Column, steps=CTR_STEPS, beyond: float = CTR_BEYOND) -> Column:
    """Expected click-through rate in percent. Position 0 falls in the first step."""
    (limit, rate), *rest = steps
    chain = F.when(position <= limit, F.lit(rate))
    for limit, rate in rest:
        chain = chain.when(position <= limit, F.lit(rate))
    return chain.otherwise(F.lit(beyond))
