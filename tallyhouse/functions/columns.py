"""Column expressions shared by the whole library. All of them stay inside the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
CENT = Decimal("0.01")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """One amount as an exact decimal. Slow per row: sums go through ``money_sum``."""
    return col(c).cast(MONEY)


def cents(c: Column | str) -> Column:
    """Whole cents of a float amount, a plain long inside generated code."""
    return F.rint(col(c) * 100).cast("bigint")


def money_sum(c: Column | str) -> Column:
    """Exact sum, independent of the order in which tasks finish, at the price of a long sum.

    A group may reach 9.2e16 units of currency; beyond that ANSI mode fails the job. Use
    ``money_total`` for sums over a whole table.
    """
    return F.sum(cents(c)).cast("decimal(20,0)") * F.lit(CENT)


def money_total(c: Column | str) -> Column:
    """Exact sum without that limit."""
    return F.sum(cents(c).cast("decimal(18,0)")) * F.lit(CENT)


def halves(c: Column | str, name: str) -> list[Column]:
    """Sums of the halves of a long, as aggregates that ``whole`` puts together. Longs hold those of 2^31 rows."""
    c = col(c)
    return [F.sum(F.shiftright(c, 32)).alias(f"{name}_high"), F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{name}_low")]


def whole(name: str) -> Column:
    """The exact sum of the longs whose halves were summed, which a long may not hold."""
    high, low = (F.col(f"{name}_{half}").cast("decimal(20,0)") for half in ("high", "low"))
    return (high * F.lit(Decimal(1 << 32)) + low).cast("decimal(38,0)")


def ratio(num: Column, den: Column) -> Column:
    """Float division, null when the denominator is null or zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def mean_money(c: Column | str) -> Column:
    """Average over an exact sum of float amounts."""
    return ratio(money_sum(c), F.count(col(c)))


def percent_change(now: Column, before: Column, digits: int = 1) -> Column:
    return F.round(ratio((now - before) * 100, before), digits)


# ---- text -------------------------------------------------------------------


# Every character that counts as whitespace when stripping text.
WHITESPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Drop whitespace of any kind at both ends (plain ``trim`` only drops blanks).

    Only texts that begin or end outside of ``!`` to ``~`` are searched for whitespace.
    """
    c = col(c)
    tidy = F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)
    return F.when(tidy, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter: ``d'oeste`` gives ``D'Oeste``.

    ``initcap`` starts words at blanks only, so a marker with a blank opens each word first.
    """
    mark = "\0 "
    opened = F.regexp_replace(col(c), r"(?<=\P{L})(?=\p{L})", mark)
    return F.replace(F.initcap(opened), F.lit(mark), F.lit(""))


def pad_zip(c: Column | str, width: int = 5) -> Column:
    """Zero-pad on the left; longer codes are kept whole, null stays null."""
    c = col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


# ---- numbers ----------------------------------------------------------------


def at_least(c: Column | str, low) -> Column:
    """Lower bound that keeps nulls (``greatest`` would skip them)."""
    c = col(c)
    return F.when(c < low, F.lit(low)).otherwise(c)


def clamp(c: Column | str, low, high) -> Column:
    c = col(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


# ---- dates ------------------------------------------------------------------


def date_key(ts: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    ts = col(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)


def date_of(key: Column | str) -> Column:
    key = col(key)
    return F.make_date(_div(key, 10000), _div(key, 100) % 100, key % 100)


def _div(c: Column, n: int) -> Column:
    return F.floor(c / n).cast("int")


def year_of(key: Column | str) -> Column:
    return _div(col(key), 10000)


def month_of(key: Column | str) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return _div(col(key), 100)


def month_label(yyyymm: Column | str) -> Column:
    """``YYYY-MM`` of a YYYYMM number."""
    m = col(yyyymm)
    return F.format_string("%d-%02d", _div(m, 100), m % 100)


def months_between_keys(later: Column | str, earlier: Column | str) -> Column:
    """Whole months between two YYYYMM numbers."""
    a, b = col(later), col(earlier)
    return (_div(a, 100) * 12 + a % 100) - (_div(b, 100) * 12 + b % 100)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Fractional days."""
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later)) / F.lit(86400e6)
