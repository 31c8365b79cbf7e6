"""A curve through several columns, to lay rows out near each other in all of them.

Each column becomes a number of ``BITS`` bits that keeps its order; their bits
interleaved, the highest first, are the place on a Z curve. A range of places
is a box in the columns, so files and row groups that hold a range have
narrow bounds on every one of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 8


def day_part(date_key: str) -> Column:
    """A YYYYMMDD key's place in its year."""
    month, day = F.floor(F.col(date_key) / 100) % 100, F.col(date_key) % 100
    return F.floor(((month - 1) * 31 + day - 1) * (1 << BITS) / 372).cast("int")


def first_byte(key: str) -> Column:
    """The first byte of a binary key, which is compared from there on."""
    return F.conv(F.hex(F.substring(F.col(key), 1, 1)), 16, 10).cast("int")


def between(number: str, low: int, high: int) -> Column:
    """A number's place between two bounds; numbers outside are at the ends."""
    part = F.floor((F.col(number).cast("double") - float(low)) / float(high - low + 1) * (1 << BITS))
    return F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), part)).cast("int")


def interleaved(*parts: Column) -> Column:
    """The place on the Z curve; a NULL part counts as 0."""
    n = len(parts)
    known = [F.coalesce(p, F.lit(0)) for p in parts]
    bits = [F.shiftleft(F.shiftright(p, b).bitwiseAND(F.lit(1)), b * n + (n - 1 - i)) for b in range(BITS) for i, p in enumerate(known)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)
