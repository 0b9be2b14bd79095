"""Numbers that arrive as text. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def real(c: Column | str) -> Column:
    """Text or number as double."""
    return _col(c).try_cast("double")


def real_comma(c: Column | str) -> Column:
    """Decimal-comma text as double; blanks around it are ignored."""
    return F.trim(F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))).try_cast("double")


def whole(c: Column | str, to: str = "int") -> Column:
    """Text as integer, rounding half away from zero (``'12.7'`` gives 13)."""
    return F.round(real(c)).try_cast(to)


def rounded_int(c: Column | str) -> Column:
    """Double rounded to an integer; NULL when it does not fit."""
    return F.round(_col(c)).try_cast("int")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Quotient that is NULL for a zero or missing divisor."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
