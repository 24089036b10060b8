"""Exact decimal shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_share(n: Column, total: Column, scale: int = 2) -> Column:
    """``n / total`` rounded HALF_UP to ``scale`` decimals, NULL if ``total`` is 0.

    Computed on integers, ``floor((2*10^s*n + total) / (2*total)) / 10^s``, so
    binary ties such as 1.005 cannot round the wrong way as ``round`` on a
    double can. ``n`` and ``total`` must be non-negative whole numbers.
    """
    unit = 10 ** scale
    num = F.lit(2 * unit) * n.cast("bigint") + total.cast("bigint")
    den = F.lit(2) * total.cast("bigint")
    # (num - num mod den) is an exact multiple of den: the division is exact.
    whole = ((num - F.pmod(num, den)) / den).cast("bigint")
    return F.when(total > 0, whole / F.lit(unit))
