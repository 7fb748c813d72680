"""Random draws that depend only on their arguments.

A draw is the first 60 bits of the md5 of the joined arguments.  It does not
depend on partitioning, task retries or row order, so a recomputed task gives
the rows it gave before, and SQL can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60
# doubles are made of the draw's first 52 bits, which they hold exactly
UNIT_BITS = 52


def draw(seed: int, *parts: Column | str | int) -> Column:
    """A uniform integer in ``[0, 2**60)``; strings and ints among ``parts`` are literals."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", F.lit(str(seed)), *cols)
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def draw_below(n: Column | int, seed: int, *parts: Column | str | int) -> Column:
    """A uniform integer in ``[0, n)``."""
    return draw(seed, *parts) % (n if isinstance(n, Column) else F.lit(n))


def draw_unit(seed: int, *parts: Column | str | int) -> Column:
    """A uniform double in ``[0, 1)``."""
    return _grid(seed, *parts) / F.lit(float(2**UNIT_BITS))


def _grid(seed: int, *parts: Column | str | int) -> Column:
    return F.shiftright(draw(seed, *parts), BITS - UNIT_BITS)


def draw_normal(seed: int, *parts: Column | str | int) -> Column:
    """A standard normal double (Box-Muller on two draws)."""
    u = (_grid(seed, *parts, "u") + 1) / F.lit(float(2**UNIT_BITS))
    v = draw_unit(seed, *parts, "v")
    return F.sqrt(-2.0 * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)
