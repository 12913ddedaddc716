"""Money as decimals.

Prices arrive as doubles with two decimals.  They are cast to decimal
before any arithmetic or sum, so totals are exact and do not depend on
the order in which partial sums are combined across tasks.

Two widths.  ``MONEY`` is what an incoming price may be: admission refuses
more as ``bad_value``.  ``WIDE`` is what totals and lines compute with: a
price beyond ``MONEY`` that stands in a table all the same is summed exactly
too.  What no decimal can hold (NaN, infinite, 1e26 and more) never ends a
query: it is left out of the sum and counted in a column of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(12, 2)     # one incoming price
WIDE = DecimalType(28, 2)      # one stored price
RATE = DecimalType(7, 6)       # a discount or tax rate, to six decimals
AMOUNT = DecimalType(37, 8)    # price * (1 - discount), exact for both
TOTAL = DecimalType(38, 2)     # sum of prices; room for one customer holding a third of all orders


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wide(c) -> Column:
    """A stored price as decimal; null if no decimal holds it."""
    return _col(c).try_cast(WIDE)


def is_price(c) -> Column:
    """True for null and for what an incoming price may be."""
    return _col(c).isNull() | _col(c).try_cast(MONEY).isNotNull()


def line_amount(price="l_extendedprice", discount="l_discount") -> Column:
    """Discounted line amount, exact: decimal(28,2) * (1 - decimal(7,6));
    null if one of them does not fit."""
    return (wide(price) * (F.lit(1).cast(DecimalType(1, 0)) - _col(discount).try_cast(RATE))).try_cast(AMOUNT)


def total(c) -> Column:
    """Exact sum of a money column, typed wide enough for any group."""
    return F.sum(wide(c)).cast(TOTAL)


def unfit(c) -> Column:
    """How many values of a money column the sum had to leave out."""
    return F.count_if(_col(c).isNotNull() & wide(c).isNull())


def as_double(c) -> Column:
    """An exact decimal result presented as a double: one correctly rounded
    conversion at the end, after all arithmetic and sums were exact.  The
    source tables carry money as doubles, so outputs do too."""
    return _col(c).cast("double")
