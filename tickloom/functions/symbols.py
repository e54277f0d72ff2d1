"""Symbols taken apart: roots of Indian scripts, OCC option symbols, and futures with month codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import US_SCALE
from .sessions import option_close_ns

_MONTH = r"(?:JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)"
#: Fixed patterns: the root is the shortest text before a year and month.
ROOTS = {"EQ": r"^[^:]+:(.+)-EQ$", "FUT": rf"^[^:]+:(.+?)\d{{2}}{_MONTH}FUT$", "OPT": rf"^[^:]+:(.+?)\d{{2}}{_MONTH}\d+(?:\.\d+)?(?:CE|PE)$"}
OCC_TAIL = r"^\d{6}[CP]\d{8}$"
MONTH_YEAR = r"([FGHJKMNQUVXZ])(\d)$"
FUTURE_OPTION = r"\s+([CP])(\d+)(?:\.(\d+))?\s*$"
MONTH_CODES = "FGHJKMNQUVXZ"
INDEX_ROOTS = ("SPX", "SPXW", "VIX", "RUT")
#: Two-digit years up to this one are of this century.
PIVOT = 30


def script_root(script: Column, kind: str) -> Column:
    """The underlying's root in an EQ, FUT or OPT script, empty if it is none."""
    return F.upper(F.regexp_extract(F.trim(F.coalesce(script, F.lit(""))), ROOTS[kind], 1))


def is_index_root(root: Column) -> Column:
    return F.upper(root).isin(*INDEX_ROOTS)


def side(letter: Column) -> Column:
    return F.when(letter == "C", "CALL").when(letter == "P", "PUT").otherwise("")


def _nanos(whole_digits: Column, fraction: Column) -> Column:
    """Digits before and after a point at the US scale, without a detour over doubles."""
    return whole_digits.try_cast("long") * US_SCALE + F.rpad(F.coalesce(fraction, F.lit("")), 9, "0").try_cast("long")


def occ(symbol: Column, pivot: int = PIVOT) -> Column:
    """root, option type, strike, expiration (nanoseconds) and whether it is an option of an index; of another symbol empty texts and zeros.

    expiration is null where the date does not exist. All but the root has a fixed width, so one pattern is matched, on the last 15 characters.
    """
    s = F.btrim(symbol, F.lit(" \t\r\n"))
    tail = F.substring(s, -15, 15)
    found = tail.rlike(OCC_TAIL)
    root = F.upper(F.replace(F.substring(s, F.lit(1), F.length(s) - 15), F.lit(" "), F.lit("")))
    yy, month, day = (F.substring(tail, i, 2).try_cast("int") for i in (1, 3, 5))
    year = yy + F.when(yy <= pivot, 2000).otherwise(1900)
    real = (month >= 1) & (month <= 12) & (day >= 1) & (day <= F.dayofmonth(F.last_day(F.make_date(year, F.when(month.between(1, 12), month).otherwise(1), F.lit(1)))))
    # A date that does not exist gives null: make_date would raise in ANSI mode.
    close = option_close_ns(F.when(found & real, F.make_date(year, month, day)), is_index_root(root))
    zero = F.lit(0).cast("long")
    return F.struct(
        F.when(found, root).otherwise("").alias("root"), F.when(found, side(F.substring(tail, 7, 1))).otherwise("").alias("option_type"),
        F.when(found, F.substring(tail, 8, 8).try_cast("long") * (US_SCALE // 1000)).otherwise(zero).alias("strike"), F.when(found, close).otherwise(zero).alias("expiration"), (found & is_index_root(root)).alias("is_index"),
    )


def month_code_expiration(base: Column, year: Column) -> Column:
    """Nanoseconds of the first of the month that a month letter and a year digit name, seen from a year; 0 without them."""
    letter, digit = F.regexp_extract(base, MONTH_YEAR, 1), F.regexp_extract(base, MONTH_YEAR, 2).try_cast("int")
    month = F.position(letter, F.lit(MONTH_CODES))
    full = year - F.pmod(year, F.lit(10)) + digit
    full = F.when(full < year - 5, full + 10).otherwise(full)
    return F.when(letter != "", F.unix_date(F.make_date(full, month, F.lit(1))).cast("long") * 86_400_000_000_000).otherwise(F.lit(0).cast("long"))


def future_or_option(symbol: Column, year: Column) -> Column:
    """option type ("" for a future), strike and expiration of a symbol such as ESZ7 P8250."""
    letter = F.regexp_extract(symbol, FUTURE_OPTION, 1)
    base = F.trim(F.regexp_replace(symbol, FUTURE_OPTION, ""))
    strike = F.when(letter != "", _nanos(F.regexp_extract(symbol, FUTURE_OPTION, 2), F.regexp_extract(symbol, FUTURE_OPTION, 3)))
    return F.struct(side(letter).alias("option_type"), F.coalesce(strike, F.lit(0).cast("long")).alias("strike"), month_code_expiration(F.when(letter != "", base).otherwise(symbol), year).alias("expiration"))


def symbol_root(symbol: Column) -> Column:
    """Leading capitals; what follows a leading dot; else the symbol itself."""
    capitals = F.regexp_extract(symbol, r"^[A-Z]+", 0)
    return F.when(symbol.startswith("."), F.substring(symbol, 2, 1 << 20)).when(capitals != "", capitals).otherwise(symbol)


def side_letter(symbol: Column) -> Column:
    """C or P before the strike digits that end a symbol."""
    return F.regexp_extract(symbol, r"([CP])\d+$", 1)


def parent_symbol(symbol: Column) -> Column:
    """The option parent of a bare root; dotted roots and symbols with a suffix stay."""
    return F.when(symbol.startswith(".") | symbol.rlike(r"\.(OPT|FUT|SPOT)$"), symbol).otherwise(F.concat(symbol, F.lit(".OPT")))
