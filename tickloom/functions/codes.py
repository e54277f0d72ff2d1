"""Code tables of the Indian feed as literal maps, and the lookups on them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import to_long

#: The feed's numeric codes.
EXCHANGES = {10: "NSE", 11: "MCX", 12: "BSE"}
SEGMENTS = {10: "CM", 11: "FO", 12: "CD", 20: "COM"}
INSTRUMENTS = {
    0: "EQ", 1: "PREFSHARES", 2: "DEBENTURES", 3: "WARRANTS", 4: "MISC", 5: "SGB", 6: "G-SECS", 7: "T-BILLS", 8: "MF", 9: "ETF", 10: "INDEX",
    11: "FUTIDX", 12: "FUTIVX", 13: "FUTSTK", 14: "OPTIDX", 15: "OPTSTK", 16: "FUTCUR", 17: "FUTIRT", 18: "FUTIRC", 19: "OPTCUR", 20: "UNDCUR",
    21: "UNDIRC", 22: "UNDIRT", 23: "UNDIRD", 24: "INDEX_CD", 25: "FUTIRD", 30: "FUTCOM", 31: "OPTFUT", 32: "OPTCOM", 33: "FUTBAS", 34: "FUTBLN",
    35: "FUTENR", 36: "OPTBLN", 37: "OPTFUT_NCOM", 50: "MISC_BSE",
}
#: Exchange code and segment code to market.
MARKETS = {(10, 10): "XNSE", (10, 11): "XNFO", (10, 12): "XNCD", (10, 20): "XNCO", (12, 10): "XBSE", (12, 11): "XBFO", (12, 12): "XBCD", (11, 20): "XMCX"}
#: Cash instruments.
CASH = ("EQ", "SPOTFWD", "SPOTCUR", "SPOTIRT", "SPOTGOLD", "SPOTSILVER", "MUTUALFUND", "BOND", "ETF", "SPOT", "SPOTSLV")


def lookup(table: dict, key: Column) -> Column:
    """table[key], null if absent. A key of several codes is a tuple, and a struct of them in the rows."""
    literal = lambda k: F.struct(*map(F.lit, k)) if isinstance(k, tuple) else F.lit(k)
    return F.try_element_at(F.create_map(*[x for k, v in table.items() for x in (literal(k), F.lit(v))]), key)


def whole(x: Column) -> Column:
    """The integer in a text of digits only, so 10.0 is none."""
    return F.when(x.cast("string").rlike(r"^\s*[+-]?\d+\s*$"), F.trim(x.cast("string")).try_cast("int"))


def market(exchange: Column, segment: Column) -> Column:
    """The market of two codes, empty if unknown."""
    return F.coalesce(lookup(MARKETS, F.struct(F.coalesce(whole(exchange), F.lit(-1)).alias("col1"), F.coalesce(whole(segment), F.lit(-1)).alias("col2"))), F.lit(""))


def segment_name(segment: Column) -> Column:
    return lookup(SEGMENTS, to_long(segment).cast("int"))


def instrument_name(code: Column) -> Column:
    text = F.trim(F.coalesce(code.cast("string"), F.lit("")))
    return F.coalesce(lookup(INSTRUMENTS, to_long(text).cast("int")), F.when(text != "", F.concat(F.lit("UNKNOWN_"), text)), F.lit("UNKNOWN"))


def instrument_class(name: Column) -> Column:
    """EQUITY, FUTURE or OPTION, else the upper-cased name itself."""
    n = F.upper(F.coalesce(name, F.lit("")))
    return F.when(n == "EQ", "EQUITY").when(n.startswith("FUT"), "FUTURE").when(n.startswith("OPT"), "OPTION").otherwise(n)


def call_or_put(code: Column) -> Column:
    c = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    return F.when(c == "CE", "CALL").when(c == "PE", "PUT").otherwise("")


def is_cash(name: Column) -> Column:
    return name.isin(*CASH)


def names_future(name: Column) -> Column:
    return name.contains("FUT")


def names_option(name: Column) -> Column:
    return name.contains("OPT")


def parse_token(token: Column) -> Column:
    """exchange, segment, date and token of an EESSYYMMDD... token; null unless it has nine characters and numeric codes."""
    ex, seg = whole(F.substring(token, 1, 2)), whole(F.substring(token, 3, 2))
    parts = F.struct(
        F.coalesce(lookup(EXCHANGES, ex), F.lit("")).alias("exchange"), F.coalesce(lookup(SEGMENTS, seg), F.lit("")).alias("segment"), F.substring(token, 5, 6).alias("date"), F.substring(token, 11, 1 << 20).alias("token")
    )
    return F.when((F.length(token) >= 9) & ex.isNotNull() & seg.isNotNull(), parts)
