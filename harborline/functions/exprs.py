"""Reusable column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
NUMERIC = "decimal(38,9)"
# Staged amounts are exact to nine decimals; sums are rounded to cents once, at the end.
STAGED = NUMERIC
# Sums enter a division as AMOUNT: wider types would leave the quotient fewer than ten decimals.
AMOUNT = "decimal(28,2)"
EXACT = "decimal(29,9)"
QUOTIENT = "decimal(38,10)"

# Taxi vendor codes and their names. A code outside the table has no name.
VENDOR_NAMES = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
    4: "Unknown Vendor",
    6: "Myle Technologies Inc",
    7: "Helix",
}

# Fixed value: stored payloads are cut to this many characters.
PAYLOAD_LIMIT = 8000

GRAIN_UNITS = {"W": "week", "M": "month", "Q": "quarter", "Y": "year"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, strict: bool = True) -> Column:
    """Text or number to decimal(18,2). Lenient mode turns unreadable text into NULL."""
    return _col(c).cast(MONEY) if strict else _col(c).try_cast(MONEY)


def amount(c: Column | str, strict: bool = True) -> Column:
    """Text or number to a staged amount. Lenient mode turns unreadable text into NULL."""
    return _col(c).cast(STAGED) if strict else _col(c).try_cast(STAGED)


def numeric(c: Column | str) -> Column:
    return _col(c).cast(NUMERIC)


def day(c: Column | str) -> Column:
    return F.to_date(_col(c))


def period_start(c: Column | str, grain: str) -> Column:
    """First day of the week (Monday), month, quarter or year; grain D is the day itself."""
    if grain == "D":
        return day(c)
    return F.date_trunc(GRAIN_UNITS[grain], _col(c)).cast("date")


def shift_years(c: Column | str, years: int) -> Column:
    return F.add_months(_col(c), 12 * years)


def hours_between(start: Column | str, end: Column | str) -> Column:
    seconds = F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(_col(start).cast("timestamp"))
    return seconds / F.lit(3600)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def ratio(num: Column | str, den: Column | str, places: int, need_positive_num: bool = False) -> Column:
    """num / den rounded, NULL unless the denominator (and the numerator, if asked) is above zero."""
    n, d = _col(num).cast(AMOUNT), _col(den).cast(AMOUNT)
    usable = d > 0
    if need_positive_num:
        usable = usable & (n > 0)
    return F.when(usable, F.round((n / d).cast(QUOTIENT), places))


def row_hash(columns: Sequence[str], raw: bool = False, sep: str = "") -> Column:
    """md5 over the text of the columns, NULL as empty text; hex by default, 16 raw bytes if asked.

    Without a separator neighbouring values run together, so ('1','23') and ('12','3') collide;
    give ``sep`` to keep them apart.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(sep, *texts).cast("binary"))
    return F.unhex(digest) if raw else digest


def vendor_name(c: Column | str) -> Column:
    chain = None
    for code, name in VENDOR_NAMES.items():
        hit = _col(c) == code
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain


def label(flag: Column | str, yes: str, no: str) -> Column:
    """yes when the flag is true, else no (also for NULL)."""
    return F.when(_col(flag), yes).otherwise(no)


def clip(c: Column | str, length: int = PAYLOAD_LIMIT) -> Column:
    return F.substring(_col(c), 1, length)


def from_millis(c: Column | str) -> Column:
    return F.timestamp_millis(_col(c))


def month_label(c: Column | str, sep: str = "-") -> Column:
    """yyyy-MM or yyyy_MM, as used in partition and file names."""
    return F.date_format(_col(c), f"yyyy{sep}MM")


def within(c: Column | str, start: str, end: str) -> Column:
    """start <= c < end: the half-open range."""
    return (_col(c) >= F.lit(start).cast("timestamp_ntz")) & (_col(c) < F.lit(end).cast("timestamp_ntz"))


def between_as_written(c: Column | str, first: str, last: str) -> Column:
    """SQL BETWEEN on date texts: stops at midnight at the start of ``last``."""
    return _col(c).between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))


def on_day(c: Column | str, date: str) -> Column:
    return day(c) == F.lit(date).cast("date")
