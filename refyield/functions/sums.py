"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at each step, so two runs that deal rows otherwise can differ
in the last digit. Here each value is split into whole multiples of a few fixed
powers of two, without rounding; those are summed as longs, which is the same in
any order, and put together at the end.

Values under 2^86 in size are split down to multiples of 2^-72, which is all of a
double of 2^-19 (two millionths) or more; what lies below is rounded, each value
for itself. Larger values, infinities and NaN are added as doubles beside the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from refyield.functions._memo import memo_columns

#: Exponents of the powers of two. A part is at most 2^23 of its power (the first:
#: 2^38), so that 2^40 values add up in a long (2^25 where all are of the largest).
EXPONENTS = (48, 24, 0, -24, -48, -72)
_LARGEST = 2.0**86


def _parts(x: Column) -> list[Column]:
    fits = F.abs(x) < _LARGEST
    steps = [F.rint(x * F.lit(2.0**-e)) for e in EXPONENTS]
    parts = [steps[0]] + [low - high * F.lit(2.0 ** (a - b)) for high, low, a, b in zip(steps, steps[1:], EXPONENTS, EXPONENTS[1:])]
    return [F.when(fits, p.cast("long")) for p in parts]


@memo_columns
def repeatable_sum(value: str) -> Column:
    """Aggregate: the sum of a column of doubles, NULL where all values are NULL."""
    x = F.col(value)
    small = reduce(Column.__add__, [F.sum(p).cast("double") * F.lit(2.0**e) for p, e in zip(_parts(x), EXPONENTS)])
    large = F.sum(F.when(F.isnan(x) | (F.abs(x) >= _LARGEST), x))
    return F.coalesce(small + large, small, large)
