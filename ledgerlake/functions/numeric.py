"""Column expressions shared by every operator.

All of them are built-in Catalyst expressions (no Python UDF), so they stay inside
whole-stage codegen and are ANSI-safe: a bad number or a zero divisor gives NULL,
never a task failure.

Rounding contract: ratios are computed in whole decimals and rounded half away from zero
to two places, then returned as double. Money and ratio inputs are quantised to cents
first (decimals, not 64-bit integers), so sums are exact, give the same answer in any
partitioning, and neither overflow nor fail; an amount beyond 25 digits is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake import schemas as S

_CENTS = "decimal(28,0)"
_WIDE = "decimal(33,0)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def finite(col) -> Column:
    """NaN and infinities -> NULL (Spark orders NaN above every number, and an infinite
    amount has no cents)."""
    c = _c(col)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def parse_double(col) -> Column:
    """Text -> double; malformed text, NaN and infinities (also by overflow) become NULL."""
    return finite(F.trim(_c(col)).try_cast("double"))


def finite_sql(column: str) -> str:
    """`finite` of a column as SQL text, for projections over many columns: one expression
    is parsed in the JVM where the functions above take a call each."""
    c = f"`{column}`"
    return f"CASE WHEN NOT isnan({c}) AND abs({c}) < double('Infinity') THEN {c} END"


def safe_bigint(col, sentinel: str = S.NONE_SENTINEL) -> Column:
    """Text amount -> bigint; the sentinel and malformed text become NULL."""
    return F.nullif(F.trim(_c(col)), F.lit(sentinel)).try_cast("bigint")


def year_of(col) -> Column:
    """Calendar year of an ISO date text (`left(x, 4)`), NULL when not a number."""
    return F.left(_c(col), F.lit(4)).try_cast("int")


def cents(col) -> Column:
    """Money/ratio double -> whole hundredths (half away from zero) as a decimal; NULL
    beyond 25 digits of whole units."""
    return (_c(col).try_cast("decimal(27,2)") * F.lit(100)).cast(_CENTS)


def from_cents(col) -> Column:
    return _c(col).cast("double") / F.lit(100.0)


def pct(numerator, denominator) -> Column:
    """round(n / d * 100, 2), half away from zero, on whole decimals; NULL when d is 0 or
    NULL, and when an operand has more than 33 digits.

    Operands are integral (amounts, or cents of money values). The hundredths of a percent
    are an integer division with the half added, so there is no intermediate rounding.
    """
    n = _c(numerator).try_cast(_WIDE)
    d = F.nullif(_c(denominator).try_cast(_WIDE), F.lit(0).cast(_WIDE))
    twice = F.lit(2) * F.abs(d)
    top = F.try_add(F.try_multiply(F.abs(n), F.lit(20000)), F.abs(d))
    whole = F.try_divide(top - top % twice, twice)
    return F.when((n < 0) != (d < 0), -whole).otherwise(whole).cast("double") / F.lit(100.0)


def avg_2dp(col) -> Column:
    """Average of a cent-precision column, rounded to 2 places, exact and order-free.

    Aggregate expression: decimal sum of cents divided by count of non-NULL values.
    """
    c = cents(col)
    return pct(F.try_sum(c), F.count(c) * F.lit(10000))


def size_class(market_cap) -> Column:
    c = _c(market_cap)
    expr = None
    for bound, label in S.SIZE_CLASSES:
        expr = (F.when(c >= F.lit(bound), label) if expr is None
                else expr.when(c >= F.lit(bound), label))
    return expr.otherwise(S.SIZE_FLOOR)


def complete_flag(market_cap, ebitda, pe_ratio) -> Column:
    """True only when all three inputs are usable; NULL comparisons give False."""
    cond = (_c(market_cap) > 0) & _c(ebitda).isNotNull() & (_c(pe_ratio) > 0)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def sum_2dp(*cols) -> Column:
    """Sum of cent-precision values as a 2-place double (exact on cents)."""
    total = None
    for c in cols:
        total = cents(c) if total is None else total + cents(c)
    return from_cents(total)
