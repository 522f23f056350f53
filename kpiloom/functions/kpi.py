"""Reusable KPI column functions.

All functions take and return ``Column`` objects built from built-in Spark
expressions, so they stay inside whole-stage codegen and never leave the JVM.

Rounding
--------
Rates and averages are rounded half away from zero on the *exact* rational
value ``num * scale / den``.  Plain ``round(double)`` can tip the wrong way on
inexact ties (23/40 at two decimals), and rounding a 6-digit decimal quotient
twice can too once denominators reach millions, so :func:`round_ratio` works in
integers: ``q = (2|n| + |d|) div 2|d|`` with ``n = num * scale * 10^k``.  The
inputs must be integral (counts, sums of integral amounts, day counts).  The
integer quotient is exact at any size (38-digit decimals); the final DOUBLE is
the correctly rounded value while ``|value| × 10^k < 2^53`` (about 9·10^13 at
two places), far above any rate, average or amount the marts produce.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# Wide enough for products of two large sums (estimated LTV at 100 TB scale).
_EXACT = "decimal(38,0)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_column(as_of: Union[_dt.date, str, Column, None]) -> Column:
    """The reporting date as a DATE column; ``None`` means today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("date")


def decimal_sql(number: str) -> str:
    """SQL of a decimal number written as text, with all its digits."""
    _, digits, exponent = Decimal(number).as_tuple()
    scale = max(0, -exponent)
    return f"CAST('{Decimal(number):f}' AS DECIMAL({max(len(digits) + max(0, exponent), scale + 1)},{scale}))"


# ---------------------------------------------------------------------------
# cleaning and date arithmetic
# ---------------------------------------------------------------------------

def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, with empty and all-blank strings turned into null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def to_date(c: ColumnOrName) -> Column:
    """Blank-tolerant strict date cast: blanks become null, bad text raises."""
    return blank_to_null(_col(c).cast("string")).cast("date")


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end`` (negative when end is earlier)."""
    return F.datediff(_col(end), _col(start)).cast("long")


def month_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    2024-01-31 → 2024-02-01 is 1, unlike ``months_between``.
    """
    s, e = _col(start), _col(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("long")


def month_start(d: ColumnOrName) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_col(d), "MM")


# ---------------------------------------------------------------------------
# exact ratios
# ---------------------------------------------------------------------------

def round_ratio_sql(num: str, den: str, decimals: int = 2, scale: int = 1) -> str:
    """SQL text of :func:`round_ratio` for SQL operands (e.g. aggregates)."""
    n = f"(CAST(({num}) AS {_EXACT}) * {scale * 10 ** decimals})"
    d = f"CAST(({den}) AS {_EXACT})"
    q = f"((abs({n}) * 2 + abs({d})) div (abs({d}) * 2))"
    return (f"CAST(CASE WHEN {d} <> 0 THEN CAST(IF(({n} < 0) <> ({d} < 0), -{q}, {q}) "
            f"AS DOUBLE) / {10 ** decimals} END AS DOUBLE)")


def round_ratio(num: ColumnOrName, den: ColumnOrName, decimals: int = 2,
                scale: int = 1) -> Column:
    """``round(num * scale / den, decimals)`` exactly, half away from zero.

    Null when ``den`` is 0 or null, or ``num`` is null.  Result is DOUBLE.
    String operands are SQL expressions (a column name is one); with two of
    them the whole expression is built from SQL text in one call.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(round_ratio_sql(num, den, decimals, scale))
    n = _col(num).cast(_EXACT) * F.lit(scale * 10 ** decimals).cast(_EXACT)
    d = _col(den).cast(_EXACT)
    q = F.call_function("div", F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, signed.cast("double") / F.lit(10 ** decimals)).cast("double")


# ---------------------------------------------------------------------------
# the six reusable macros
# ---------------------------------------------------------------------------

def safe_divide(num: ColumnOrName, den: ColumnOrName, default=0) -> Column:
    """``num / den``, or ``default`` when ``den`` is 0 or null."""
    n, d = _col(num), _col(den)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return F.when(d.isNull() | (d == 0), dflt).otherwise(n / d)


def pct(num: ColumnOrName, den: ColumnOrName, decimals: int = 2) -> Column:
    """Percentage of integral ``num`` over ``den``; **0** when ``den`` is 0/null.

    (The inline mart rates return null on an empty denominator; see
    :func:`round_ratio`.)
    """
    d = _col(den)
    return (F.when(d.isNull() | (d == 0), F.lit(0.0))
            .otherwise(round_ratio(num, d, decimals, 100)))


def nps_score(promoters: ColumnOrName, detractors: ColumnOrName,
              total: ColumnOrName) -> Column:
    """Net promoter score, −100…100 at one decimal; null when total is 0."""
    return round_ratio(_col(promoters) - _col(detractors), total, 1, 100)


# First and last day of each overdue bucket (None: no end), and its
# label; everything else is current.
AGING_BUCKETS = (
    (1, 30, "1-30 days"),
    (31, 60, "31-60 days"),
    (61, 90, "61-90 days"),
    (91, None, "90+ days"),
)
CURRENT = "current"


def aging_bucket(days_overdue: ColumnOrName) -> Column:
    """Overdue-age bucket of a day count; 0, negative and null are 'current'."""
    d = _col(days_overdue)
    out = F.lit(CURRENT)
    for low, high, label in AGING_BUCKETS:
        inside = d >= low if high is None else d.between(low, high)
        out = F.when(inside, F.lit(label)).otherwise(out)
    return out


def _lexical_buckets() -> str:
    return ", ".join(f"'{b}'" for b in sorted([CURRENT, *(label for _, _, label in AGING_BUCKETS)]))


def bucket_rank_sql(bucket: str) -> str:
    """SQL: position of a bucket label in lexical order (null for null)."""
    return f"NULLIF(array_position(array({_lexical_buckets()}), {bucket}), 0)"


def lexical_max_bucket_sql(bucket: str) -> str:
    """SQL aggregate: the lexically greatest bucket label of a group.

    Equal to ``max(bucket)`` on the labels, but aggregates an integer rank, so
    Spark keeps a hash aggregate with map-side combining (a string ``max``
    forces a sort-based aggregate).
    """
    return (f"element_at(array({_lexical_buckets()}), "
            f"CAST(max({bucket_rank_sql(bucket)}) AS INT))")


def classify_nps(score: ColumnOrName, high: int = 9, low: int = 6,
                 passive: int = 7) -> Column:
    """promoter (≥ high), passive (≥ 7), detractor (≤ low), else null."""
    s = _col(score)
    return (F.when(s >= high, F.lit("promoter"))
            .when(s >= passive, F.lit("passive"))
            .when(s <= low, F.lit("detractor")))


def region_of(country: ColumnOrName) -> Column:
    """Sales region of a two-letter market code; null for other markets."""
    c = _col(country)
    # Market → region.
    return (F.when(c.isin("DK", "NO", "SE"), F.lit("Scandinavia"))
            .when(c == "DE", F.lit("DACH"))
            .when(c == "NL", F.lit("Benelux"))
            .when(c == "US", F.lit("North America")))


def sql_exprs(*texts: str):
    """SQL expression strings as Columns (one call each, e.g. for ``agg``)."""
    return [F.expr(t) for t in texts]


def typed_null(dtype: str) -> Column:
    """A null literal of the given Spark SQL type (for union padding)."""
    return F.lit(None).cast(dtype)
