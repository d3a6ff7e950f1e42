"""Rounding of doubles to four places by their binary value, as Python's ``round`` does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on doubles lie so far apart that the nearest to four rounded places is the number itself.
_WIDE = float(2**39)


def round_4(x: Column) -> Column:
    """A double of 0 or more to four places, exact halves to even.

    What is behind the point is exact as a double of its own. The sign of ``20000 * part - (2 * n + 1)`` decides between n and
    n + 1 ten-thousandths of it; it is taken without rounding error, from the upper and lower bits of the part. The
    quotient of two whole numbers below 2**53 is the double nearest to the decimal.
    """
    whole = F.floor(x).cast("double")
    part = x - whole
    n = F.floor(part * 10000).cast("double")
    spread = part * float(2**27 + 1)
    upper = spread - (spread - part)
    above = (upper * 20000.0 - (2 * n + 1)) + (part - upper) * 20000.0
    up = F.when(above > 0, 1.0).when(above < 0, 0.0).otherwise(n % 2)
    return F.when(x < _WIDE, (whole * 10000.0 + n + up) / F.lit(10000.0)).otherwise(x)
