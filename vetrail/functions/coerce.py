"""Null and type coercions with the semantics the data needs (Spark's defaults differ)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_in_or_null(c: Column | str, values: Iterable) -> Column:
    """Exclusion that keeps null rows; plain ``~isin`` would drop them."""
    c = _col(c)
    return c.isNull() | ~c.isin(list(values))


def is_value(c: Column | str, value) -> Column:
    """1 where the column equals the value, else 0, null included."""
    return _col(c).eqNullSafe(F.lit(value)).cast("int")


def lacks_text(c: Column | str, text: str) -> Column:
    """Case-insensitive substring exclusion that keeps null rows."""
    return ~F.coalesce(F.contains(F.lower(_col(c)), F.lit(text.lower())), F.lit(False))


def strict_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; an empty text is null, anything else unreadable raises (ANSI mode)."""
    return F.to_date(F.nullif(_col(c), F.lit("")), fmt)


def coerced_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; whatever cannot be read is null."""
    return F.try_to_date(F.nullif(_col(c), F.lit("")), fmt)


def coerced_long(c: Column | str) -> Column:
    """Text to whole number: unreadable text is null, a fraction raises.

    Digits alone are read as they are; only texts such as "12.0" go through a double.
    """
    text = F.trim(_col(c).cast("string"))
    exact = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
    number = text.try_cast("double")
    whole = F.floor(number)
    fraction = F.raise_error(F.concat(F.lit("not a whole number: "), number.cast("string")))
    return (
        F.when(exact.isNotNull(), exact)
        .when(number.isNull() | F.isnan(number), F.lit(None).cast("bigint"))
        .when(number == whole, whole.cast("bigint"))
        .otherwise(fraction.cast("bigint"))
    )


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed whole days between two timestamps, floored (not calendar days)."""
    micros = F.unix_micros(_col(later).cast("timestamp")) - F.unix_micros(
        _col(earlier).cast("timestamp")
    )
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def text_or_nan(c: Column | str) -> Column:
    """A category as text, with the text ``nan`` for a missing one."""
    return F.coalesce(_col(c).cast("string"), F.lit("nan"))
