"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from claimwright.contracts import DATE_SHAPE, MONEY, Kind


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_as_null(c: Column | str) -> Column:
    """NULL for an empty or all-space value; any other value as it is, not trimmed."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def trimmed(c: Column | str) -> Column:
    c = F.trim(_col(c))
    return F.when(c != "", c)


def code(c: Column | str) -> Column:
    return F.upper(trimmed(c))


def strict_date(c: Column | str) -> Column:
    """yyyy-MM-dd only. Malformed text becomes NULL instead of failing the job under ANSI.

    Shape check and cast rather than a format parser: the parser pays an exception per bad value.
    """
    c = _col(c)
    return F.when(c.rlike(DATE_SHAPE), c.try_cast("date"))


def amount(c: Column | str) -> Column:
    return _col(c).try_cast(MONEY)


BY_KIND = {
    Kind.RAW: blank_as_null,
    Kind.TEXT: trimmed,
    Kind.CODE: code,
    Kind.DATE: strict_date,
    Kind.AMOUNT: amount,
}


def month_of(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def lineage_date(timestamp_text: Column | str) -> Column:
    """Date part of an ISO-8601 string."""
    return F.substring(_col(timestamp_text), 1, 10)


def content_digest(columns: Iterable[str]) -> Column:
    """SHA-256 of the row content: values joined by a pipe, NULL as an empty string."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def failing(rules: Sequence[tuple[str, Column]]) -> Column:
    """Names of the rules whose condition is true, in declaration order.

    A NULL condition adds no name. A concat of one-element arrays is compiled, which a
    higher-order filter is not.
    """
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(broken, F.array(F.lit(name))).otherwise(none) for name, broken in rules])


def spread_nulls(key: Column | str, *others: str) -> Column:
    """Join key whose NULLs hash to many partitions instead of one.

    The filler is derived from the row itself, so a task that is run again after an executor is
    lost sends every row to the same place. Callers must still treat a NULL key as unmatched.
    """
    key = _col(key)
    filler = F.concat(F.lit("\u0000"), F.xxhash64(*others).cast("string"))
    return F.coalesce(key, filler)


def percent(part: Column, whole: Column) -> Column:
    """Two-decimal percentage, NULL when there is nothing to divide by."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def exact_sum(c: Column | str) -> Column:
    """Sum of money that does not depend on the order in which the tasks finish."""
    return F.sum(_col(c).cast("decimal(18,2)"))


def money_sum(c: Column | str) -> Column:
    return F.round(exact_sum(c).cast("double"), 2)


def money_avg(c: Column | str) -> Column:
    c = _col(c)
    return F.round(exact_sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)), 2)
