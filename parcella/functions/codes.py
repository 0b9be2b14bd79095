"""Administrative codes: always strings, never numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def territory_code(c: Column | str, width: int = 5) -> Column:
    """Commune code padded with zeros (longer input is cut, as ``lpad`` does)."""
    return F.lpad(_col(c).cast("string"), width, "0")


def zero_filled(c: Column | str, width: int = 5) -> Column:
    """Trimmed code padded with zeros; longer input is left alone."""
    text = F.trim(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def department_code(c: Column | str) -> Column:
    """Trimmed department code, at least two characters, never shortened."""
    text = F.trim(_col(c).cast("string"))
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def department_of(commune: Column | str) -> Column:
    """Department of a commune code: three characters overseas (97x), else two."""
    code = _col(commune)
    return F.when(code.startswith("97"), F.substring(code, 1, 3)).otherwise(
        F.substring(code, 1, 2)
    )
