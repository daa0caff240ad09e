"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrar.schema import GRADE_MAX, GRADE_MIN, GRADE_TYPE, MONEY_TYPE, PASS_MARK


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def passed(grade="grade") -> Column:
    """Grade is a pass (null grade is not)."""
    return col(grade) >= F.lit(PASS_MARK)


def to_grade(raw) -> Column:
    """Store a raw numeric grade as NUMERIC(5,2): the value is rounded half-up."""
    return col(raw).cast(GRADE_TYPE)


def to_money(raw) -> Column:
    return col(raw).cast(MONEY_TYPE)


def valid_grade(raw) -> Column:
    """Range check on the raw value, before storage rounding: null and NaN fail."""
    c = col(raw).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (c >= F.lit(GRADE_MIN)) & (c <= F.lit(GRADE_MAX))


def cents(value) -> Column:
    """A NUMERIC(x,2) value as a whole number of hundredths (exact)."""
    return (col(value) * F.lit(100)).cast("long")


def rounded_mean_from_cents(sum_cents, n) -> Column:
    """mean = sum/n rounded half-up to 2 decimals, computed exactly on integers.

    ``(2*s + n) div (2*n)`` is ``round_half_up(s/n)`` for s >= 0; the result is a
    DOUBLE with two decimals (null when n = 0). Exact for any group size, unlike
    ``round(avg(decimal))`` which Spark first rounds to 6 decimals.
    """
    s, n = col(sum_cents), col(n)
    num = F.lit(2) * s + n
    den = F.lit(2) * n
    q = ((num - F.pmod(num, den)) / den).cast("long")
    return F.when(n > 0, q / F.lit(100.0))


def avg_2dp(value) -> tuple[Column, Column]:
    """Aggregates (sum of cents, count) whose ratio :func:`rounded_mean_from_cents` rounds."""
    c = cents(value)
    return F.sum(c), F.count(c)


def course_code(n) -> Column:
    """Course code of course number n: 'C' and the number, zero-padded to 3 digits at least."""
    digits = col(n).cast("string")
    return F.concat(F.lit("C"), F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits))


def nonblank(c) -> Column:
    """String present and not empty (the reference tests ``not value``)."""
    return col(c).isNotNull() & (F.length(col(c)) > 0)


def first_reason(*checks: tuple[Column, str], ok: str = "ok") -> Column:
    """First failing check in order -> its reason code; ``ok`` when all pass.

    Each check is (condition_that_must_hold, reason). A null condition counts as
    failing, so missing data never slips through as accepted.
    """
    expr = None
    for cond, reason in checks:
        failed = ~F.coalesce(cond, F.lit(False))
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return expr.otherwise(F.lit(ok))
