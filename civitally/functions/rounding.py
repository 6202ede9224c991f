"""Published rounding and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(x: Column) -> Column:
    """Two decimals, half away from zero, kept as a decimal.

    The inner cast removes binary noise such as 0.125 stored as 0.12499999.
    """
    return F.round(x.cast("decimal(20,8)"), 2)


def published(x: Column) -> Column:
    return x.cast("double")


def ratio_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole, null when the whole is zero."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def change_pct(current: Column, previous: Column) -> Column:
    """Percent change against the previous value, null when that is zero."""
    return ratio_pct(current - previous, previous)


def display_round(x: Column, digits: int) -> Column:
    return F.round(x.cast("decimal(20,8)"), digits).cast("double")


def or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0).cast("double"))


def trend(delta: Column, lower_is_better: bool = False) -> Column:
    """'up', 'down' or 'flat' in the sense of better or worse."""
    sign = F.signum(-delta if lower_is_better else delta)
    return F.when(sign > 0, "up").when(sign < 0, "down").when(sign == 0, "flat")
