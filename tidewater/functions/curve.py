"""Position on a space-filling curve: rows that are close in two columns are close in one order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BITS = 16


def scaled(value: Column, low, high) -> Column:
    """``value`` as an integer of ``BITS`` bits; ``low`` .. ``high`` is its range, null counts as ``low``."""
    width = max(float(high) - float(low), 1e-9)
    place = F.floor((value.cast("double") - F.lit(float(low))) / F.lit(width) * ((1 << BITS) - 1))
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), place)), F.lit(0)).cast("long")


def interleave(a: Column, b: Column) -> Column:
    """The bits of both in turn, those of ``a`` first (Z-order)."""

    def spread(x: Column) -> Column:
        # 16 bits to every second of 32, by halves
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask).cast("long"))
        return x

    return F.shiftleft(spread(a), 1).bitwiseOR(spread(b))
