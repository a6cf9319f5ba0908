"""Column expressions shared by the silver rules and the data-quality checks.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.functions.codes import UNKNOWN


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized(c: str | Column) -> Column:
    """``upper(trim(c))``: the form codes are compared in."""
    return F.upper(F.trim(col_(c)))


def map_code(c: str | Column, mapping: Mapping[str, str], default: str | Column | None = UNKNOWN,
             normalize=normalized) -> Column:
    """Searched CASE over ``normalize(c)``; unlisted codes (and NULL) give ``default``."""
    key = normalize(c)
    targets: dict[str, list[str]] = {}
    for src, dst in mapping.items():
        targets.setdefault(dst, []).append(src)
    expr = None
    for dst, srcs in targets.items():
        cond = key == srcs[0] if len(srcs) == 1 else key.isin(srcs)
        expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def int_to_date(c: str | Column) -> Column:
    """An integer ``yyyymmdd`` as a DATE; 0, a length other than 8, or no such day -> NULL.

    Pure integer arithmetic (no string formatting or parsing): year, month and day are split off
    with ``div`` / ``%``, the month and day are checked against the calendar (``last_day``), and
    only then is the date built. The source system fails the whole load on an 8-digit value that
    is not a date; here the row keeps a NULL and the load audit counts it (``bad_int_date``).
    """
    c = col_(c)
    year = F.call_function("div", c, F.lit(10000)).cast("int")
    month = (F.call_function("div", c, F.lit(100)) % 100).cast("int")
    day = (c % 100).cast("int")
    eight_digits = (c >= 10_000_000) & (c <= 99_999_999)
    first = F.when(eight_digits & (month >= 1) & (month <= 12) & (day >= 1),
                   F.make_date(year, month, F.lit(1)))
    return F.when(day <= F.dayofmonth(F.last_day(first)), F.date_add(first, day - 1))


def bad_int_date(c: str | Column) -> Column:
    """True where an integer date is present, 8 characters long, but no calendar day."""
    return has_eight_digits(c) & int_to_date(c).isNull()


def strip_prefix(c: str | Column, prefix: str) -> Column:
    """Drop a leading ``prefix`` (case-sensitive) when present."""
    c = col_(c)
    return F.when(c.startswith(prefix), remainder_from(c, len(prefix) + 1)).otherwise(c)


def remainder_from(c: str | Column, start: int) -> Column:
    """Characters from 1-based position ``start`` to the end ('' when the string is shorter)."""
    return col_(c).substr(F.lit(start), F.length(col_(c)))


def day_before(c: str | Column) -> Column:
    """The calendar day before a timestamp or date, as a DATE."""
    return F.date_sub(F.to_date(col_(c)), 1)


def has_outer_spaces(c: str | Column) -> Column:
    """True where ``c`` differs from its trimmed form, i.e. starts or ends with a space (tested
    without building the trimmed copy)."""
    c = col_(c)
    return c.startswith(" ") | c.endswith(" ")


def has_eight_digits(c: str | Column) -> Column:
    """True where the integer ``c`` prints as exactly 8 characters (sign included), by range."""
    c = col_(c)
    return ((c >= 10_000_000) & (c <= 99_999_999)) | ((c >= -9_999_999) & (c <= -1_000_000))

