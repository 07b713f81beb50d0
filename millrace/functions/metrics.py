"""Scalar building blocks of the mart metrics.

All are built-in Column expressions.  Two need care to give the same numbers
as the reference database:

* ``round2``: the database rounds a double by scaling by 100, rounding half
  away from zero and dividing back.  Spark's ``round(x, 2)`` rounds the
  decimal text of ``x`` (so 1.005 -> 1.01 where the database gives 1.0).
  Rounding ``x * 100`` to an integer and dividing is identical in both.
* decimal / decimal: the database yields a double, Spark a decimal(38,20);
  both operands are turned into doubles first and the order ``a / b * 100``
  is kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """Round a double to 2 places the way the reference database does."""
    return F.round(_col(c).cast("double") * 100) / 100


def ratio_percent(numerator, denominator) -> Column:
    """``numerator / denominator * 100`` in double; NULL when the denominator
    is NULL or 0 (no ANSI divide-by-zero error)."""
    den = _col(denominator).cast("double")
    return _col(numerator).cast("double") / F.nullif(den, F.lit(0.0)) * 100


def day_diff(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (``end - start``) as bigint."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def hours_between(start, end) -> Column:
    """Elapsed hours between two timestamps, as a double (microsecond exact)."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros.cast("double") / 1e6 / 3600


def surrogate_key(*parts) -> Column:
    """Lower-hex MD5 of the parts joined by '|' (NULL parts are skipped)."""
    return F.md5(F.concat_ws("|", *[_col(p) for p in parts]))
