"""Value rules shared by all queries: money rounding, blanks, null order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A decimal(15,2) amount as whole cents."""
    return (amount * 100).cast("bigint")


def money(whole_cents: Column) -> Column:
    """Whole cents back to decimal(15,2); a value that does not fit is an error, never NULL."""
    limit = 10**15
    fits = whole_cents.isNull() | ((whole_cents > -limit) & (whole_cents < limit))
    in_range = F.when(fits, whole_cents).otherwise(F.raise_error(F.lit("amount exceeds decimal(15,2)")).cast("bigint"))
    return (in_range.cast("decimal(17,0)") / 100).cast("decimal(15,2)")


def rounded_ratio(total: Column, n: Column) -> Column:
    """total / n to two digits, half away from zero, in exact arithmetic; NULL when n is 0.

    Division of decimals rounds once before ROUND does, which misjudges ties in large groups.
    """
    in_cents = (total * 100).cast("decimal(38,0)")
    quotient = F.call_function("div", F.abs(in_cents) * 2 + n, n * 2)
    signed = F.when(in_cents < 0, -quotient).otherwise(quotient)
    return F.when(n > 0, (signed.cast("decimal(19,0)") / 100).cast("decimal(19,2)"))


def rounded_avg(amount: Column) -> Column:
    """Exact average of a money column to two digits; NULLs do not count."""
    return rounded_ratio(F.sum(amount), F.count(amount))


def sum_or_zero(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0).cast("decimal(25,2)"))


def sum_of_type(kind: str) -> Column:
    """Total amount of one transaction type, 0 where there is none."""
    return F.expr(f"coalesce(sum(IF(transaction_type = '{kind}', amount, 0)), 0)")


def count_of(column: str, value: str) -> Column:
    return F.expr(f"count_if({column} = '{value}')")


def blank_to_null(text: Column) -> Column:
    """The bank stores empty text as NULL."""
    return F.nullif(text, F.lit(""))


def ascending(*names: str) -> list[Column]:
    """Ascending keys, NULLs last."""
    return [F.col(n).asc_nulls_last() for n in names]


def descending(*names: str) -> list[Column]:
    """Descending keys, NULLs first."""
    return [F.col(n).desc_nulls_first() for n in names]
