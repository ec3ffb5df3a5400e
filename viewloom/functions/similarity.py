"""Name similarity between 0 and 1, as one Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Endings that carry no meaning, in the order they are taken out.
NOISE = ("_p", "_r", "_cd", "_dat", "_code")

# Scores of the near matches and weights of the general score.
SCORE_SAME_CORE, SCORE_CONTAINED = 0.9, 0.8
WEIGHT_LETTERS, WEIGHT_LENGTH = 0.7, 0.3


def _folded(c: Column) -> Column:
    return F.trim(F.lower(c))


def _core(c: Column) -> Column:
    for noise in NOISE:
        c = F.replace(c, F.lit(noise), F.lit(""))
    return c


def _letters(c: Column) -> Column:
    # split on '' leaves no empty entry in Spark except for the empty string itself
    return F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))


def similarity(left: Column, right: Column) -> Column:
    """1 equal, .9 equal without noise, .8 one inside the other, else letters shared and length ratio."""
    a, b = _folded(left), _folded(right)
    x, y = _core(a), _core(b)
    shared = F.size(F.array_intersect(_letters(x), _letters(y)))
    either = F.size(F.array_union(_letters(x), _letters(y)))
    shorter, longer = F.least(F.length(x), F.length(y)), F.greatest(F.length(x), F.length(y))
    general = shared / either * WEIGHT_LETTERS + (1 - (longer - shorter) / longer) * WEIGHT_LENGTH
    missing = F.coalesce(left, F.lit("")) == ""
    missing = missing | (F.coalesce(right, F.lit("")) == "")
    return (
        F.when(missing, F.lit(0.0))
        .when(a == b, F.lit(1.0))
        .when(x == y, F.lit(SCORE_SAME_CORE))
        .when(F.contains(x, y) | F.contains(y, x), F.lit(SCORE_CONTAINED))
        .otherwise(general)
    )
