"""Scores of a sequence of feelings, as aggregates of its rows: one pass over a key, combined before the shuffle.

Rows have valence, arousal and a probability for each of KINDS. The weights and bounds are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("Neutral", "Happy", "Sad", "Surprise", "Fear", "Disgust", "Anger", "Contempt")
#: Intensities below which a style is of the name; the last has no bound.
STYLES = ((0.3, "reserved"), (0.6, "moderate"), (0.8, "expressive"), (None, "highly_expressive"))
#: The greatest intensity, its root of 2 as the scores take it.
MOST = 1.414


def capped(c: Column) -> Column:
    return F.least(F.lit(1.0), c)


def unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), capped(c))


def share(test: Column) -> Column:
    return F.avg(test.cast("double"))


def mean(parts: list[Column]) -> Column:
    return sum(parts[1:], parts[0]) / len(parts)


def body_signals(valence: str, arousal: str, kinds: dict[str, str], flashes: Column | None = None) -> dict[str, Column]:
    """stress, confidence, tension and nervousness, from 0 to 1; ``flashes`` is the rate of brief expressions, if it is known."""
    v, a = F.col(valence), F.col(arousal)
    of = lambda *names: F.avg(sum((F.col(kinds[n]) for n in names[1:]), F.col(kinds[names[0]])))
    varies, high = (F.var_pop(v) + F.var_pop(a)) / 2, share(a > 0.4)
    rate = lambda most: [capped(flashes / most)] if flashes is not None else []
    # Parts are added from the left, a 1 as a part of its own, as the SQL adds them: another order ends in another last bit.
    return {
        "stress": unit(mean([share((a > 0.3) & (v < 0)), of("Fear", "Anger"), capped(varies * 2), *rate(2.0)])),
        "confidence": unit((share(v > 0.2) + share((a > -0.2) & (a < 0.5)) + of("Happy", "Neutral") + 1 - capped(varies)) / 4),
        "tension": unit((high + 1 - capped(varies * 2) + of("Sad", "Anger", "Fear")) / 3),
        "nervousness": unit(mean([capped(varies * 3), high, of("Fear", "Surprise"), *rate(1.5)])),
    }


def individuality(valence: str, arousal: str, kinds: dict[str, str]) -> dict[str, Column]:
    """intensity (mean length of valence and arousal), expressivity, range of feelings and the style's name."""
    length = F.sqrt(F.col(valence) * F.col(valence) + F.col(arousal) * F.col(arousal))
    level, spread, wide = F.avg(length), F.stddev_pop(length), F.max(length) - F.min(length)
    means = [F.avg(kinds[k]) for k in KINDS]
    active = sum((F.when(m > 0.1, 1).otherwise(0) for m in means), F.lit(0))
    entropy = sum((F.when(m > 0, -m * F.log2(m)).otherwise(0.0) for m in means), F.lit(0.0))
    style = None
    for bound, name in STYLES:
        style = F.when(level < bound, name) if style is None else style.when(level < bound, name) if bound else style.otherwise(name)
    steady = F.when(spread < 0.1, "_stable").when(spread > 0.3, "_variable").otherwise("")
    return {
        "intensity": level,
        "expressivity": capped(level / MOST) * 0.4 + capped(spread / 0.5) * 0.3 + capped(wide / MOST) * 0.3,
        "feeling_range": active / len(KINDS) * 0.5 + entropy / F.log2(F.lit(float(len(KINDS)))) * 0.5,
        "style": F.concat(style, steady),
    }
