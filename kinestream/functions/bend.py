"""Bending chains of three bones: the flexion that reaches a tip, by bisection in columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinestream.functions.vec import add, cross, let, norm, scale, sub, unit, dot

#: The last joint bends by so much of the one before; the largest bends of both in degrees; slack of reach; steps of the search.
RATIO, MOST_MIDDLE, MOST_LAST, SLACK, STEPS = 0.65, 110.0, 75.0, 1e-6, 64


def reach(lengths: Sequence[float], bend: Column) -> Column:
    """Where a chain ends that points along x and bends: struct x, y."""
    a, b, c = map(float, lengths)
    both = bend * (1 + RATIO)
    return F.struct((a + b * F.cos(bend) + c * F.cos(both)).alias("x"), (b * F.sin(bend) + c * F.sin(both)).alias("y"))


def most_bend() -> float:
    return min(math.radians(MOST_MIDDLE), math.radians(MOST_LAST) / RATIO)


def flexion(distance: Column, lengths: Sequence[float]) -> Column:
    """The bend in radians at which the chain's ends are ``distance`` apart; null beyond what the straight or the most bent chain reaches by more than SLACK.

    The distance falls as the bend grows, so halving the range STEPS times finds it, as one fold over the steps. A tip out of reach is never moved.
    """
    far = lambda bend: let(reach(lengths, bend), lambda r: F.hypot(r["x"], r["y"]))

    def halved(s: Column, _: Column) -> Column:
        def next_range(m: Column) -> Column:
            short = far(m) > s["d"]
            return F.struct(F.when(short, m).otherwise(s["low"]).alias("low"), F.when(short, s["high"]).otherwise(m).alias("high"), s["d"].alias("d"))

        return let((s["low"] + s["high"]) * 0.5, next_range)

    def solved(d: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("low"), F.lit(most_bend()).alias("high"), d.alias("d"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halved, lambda s: (s["low"] + s["high"]) * 0.5)
        straight = float(sum(lengths))
        return F.when((d <= straight + SLACK) & (d >= far(F.lit(most_bend())) - SLACK), F.when(d >= straight - SLACK, 0.0).otherwise(found))

    return let(distance.cast("double"), solved)


def bent_chain(base: Column, tip: Column, lengths: Sequence[float], normal: Column, side: int = 1) -> Column:
    """The two joints between base and tip of a chain that bends evenly in the plane across ``normal``: struct bend (degrees), middle, last.

    ``side`` -1 is the mirrored chain. Null where the tip is out of reach, is the base, or the normal points along the chord.
    """
    a, b, _ = map(float, lengths)

    def placed(s: Column) -> Column:
        end = reach(lengths, s["bend"])
        first = let(end, lambda r: -side * F.atan2(r["y"], r["x"]))
        heading = lambda angle: add(scale(s["axis"], F.cos(angle)), scale(s["across"], F.sin(angle)))

        def joints(q: Column) -> Column:
            middle = add(s["base"], scale(heading(q), a))
            return let(middle, lambda m: F.struct(F.degrees(s["bend"]).alias("bend"), m.alias("middle"), add(m, scale(heading(q + side * s["bend"]), b)).alias("last")))

        return F.when(s["bend"].isNotNull() & s["axis"].isNotNull() & s["across"].isNotNull(), let(first, joints))

    def framed(g: Column) -> Column:
        chord = sub(g["tip"], g["base"])
        axis = unit(chord)
        across = let(axis, lambda x: let(unit(sub(g["normal"], scale(x, dot(g["normal"], x))), 1e-8), lambda n: F.when(n.isNotNull(), unit(cross(n, x)))))
        return F.struct(g["base"].alias("base"), axis.alias("axis"), across.alias("across"), flexion(norm(chord), lengths).alias("bend"))

    given = F.struct(base.alias("base"), tip.alias("tip"), normal.alias("normal"))
    return let(given, lambda g: let(framed(g), placed))
