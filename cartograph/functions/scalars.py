"""Scalar column helpers (all built-in expressions, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel code labels and calendar names.
CHANNEL_LABELS = {1: "Store", 2: "Online"}
WEEKDAY_ORDER = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den, plus_one: bool = False) -> Column:
    """num / den (or num / (den + 1)); null when the denominator is 0 or null."""
    d = col_(den) + F.lit(1) if plus_one else col_(den)
    return F.try_divide(col_(num).cast("double"), d.cast("double"))


def pct(num, den) -> Column:
    return safe_ratio(num, den) * F.lit(100.0)


def clip_upper(c, upper) -> Column:
    """Cap at ``upper``; nulls stay null (``least`` would skip them)."""
    x = col_(c)
    return F.when(x > F.lit(upper), F.lit(upper)).otherwise(x)


def label_map(c, mapping: dict, default=None) -> Column:
    """Code → label through a literal map (null for unknown codes unless default)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = m[col_(c)]
    return out if default is None else F.coalesce(out, F.lit(default))


def channel_name(c="sales_channel_id") -> Column:
    return F.when(col_(c) == 1, F.lit("Store")).when(col_(c) == 2, F.lit("Online"))


def bin_label(c, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """pandas.cut-style binning.

    right=False: [lo, hi) intervals (the top edge falls out);
    right=True:  (lo, hi] intervals (the bottom edge falls out).
    Values outside every interval give null.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = col_(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi) if right else (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def is_null_or_nan(c, numeric: bool) -> Column:
    x = col_(c)
    return (x.isNull() | F.isnan(x)) if numeric else x.isNull()


def null_fill(c, value) -> Column:
    return F.coalesce(col_(c), F.lit(value))


def round_to(c, digits: int) -> Column:
    """Round half away from zero on the scaled double: round(x * 10^d) / 10^d."""
    f = float(10 ** digits)
    return F.round(col_(c) * F.lit(f), 0) / F.lit(f)


def round6(c) -> Column:
    return round_to(c, 6)


def money(c, scale: int | None):
    """The value to sum for money: integer minor units (e.g. cents) when a scale is given.

    ``rint(x · 10^scale)`` as a long — exact for amounts quoted at that scale;
    sums of longs are exact, so the result does not depend on the order in which
    partial sums are combined.
    """
    return col_(c) if scale is None else F.rint(col_(c) * F.lit(float(10 ** scale))).cast("long")


def money_unscale(total, scale: int | None) -> Column:
    """A summed ``money`` column back to a double amount (one correctly rounded division)."""
    return col_(total) if scale is None else col_(total) / F.lit(float(10 ** scale))


def money_sum(c, scale: int | None = None) -> Column:
    """Sum of a money column as double (exact integer arithmetic when ``scale`` is given)."""
    return money_unscale(F.sum(money(c, scale)), scale)


def money_avg(c, scale: int | None = None) -> Column:
    if scale is None:
        return F.avg(col_(c))
    return money_sum(c, scale) / F.count(col_(c))


def money_stddev(c, scale: int | None = None) -> Column:
    """Sample standard deviation of a money column.

    With ``scale`` it is computed from exact integer moments of the minor units
    (n, Σx, Σx² — the squares in DECIMAL(38,0)), so the only rounding is the
    final division and square root: the result no longer depends on the order
    in which partial aggregates merge.  Null for fewer than two values.
    """
    if scale is None:
        return F.stddev_samp(col_(c))
    x = money(c, scale)
    return stddev_of_moments(F.count(x), F.sum(x.cast("decimal(20,0)")), F.sum(money_square(c, scale)), scale)


def money_square(c, scale: int | None = None) -> Column:
    """The square of ``money``, as DECIMAL(38,0) where that is an integer."""
    x = money(c, scale) if scale is None else money(c, scale).cast("decimal(38,0)")
    return x * x


def stddev_of_moments(n: Column, total: Column, squares: Column, scale: int | None = None) -> Column:
    """Sample standard deviation from a count and the sums of ``money`` and of ``money_square``.

    Exact moments with ``scale``, doubles without.  Null for fewer than two values.
    """
    m = n.cast("double")  # n * (n - 1) leaves the 64-bit integers beyond about three billion rows
    if scale is None:
        return F.when(n > 1, F.sqrt(F.greatest((squares - total * total / m) / (m - F.lit(1.0)), F.lit(0.0))))
    s1 = total.cast("decimal(38,0)")
    num = n.cast("decimal(38,0)") * squares - s1 * s1
    return F.when(n > 1, F.sqrt(num.cast("double") / (m * (m - F.lit(1.0)))) / F.lit(float(10 ** scale)))
