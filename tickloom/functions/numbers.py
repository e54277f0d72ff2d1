"""Text to numbers as the raw feeds need it: bad text never raises, prices are fixed-point longs rounded half to even."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal text; Java alone would also take forms such as 1.5d.
NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INDIA_SCALE, US_SCALE = 100, 1_000_000_000


def to_double(x: Column) -> Column:
    """The number in a text, null where there is none; nan and inf are none."""
    s = x.cast("string")
    return F.when(s.rlike(NUMERIC), F.trim(s).try_cast("double"))


def to_long(x: Column) -> Column:
    """The number in a text truncated towards zero, or null."""
    return to_double(x).try_cast("long")


def scale_price(x: Column, scale: int = INDIA_SCALE) -> Column:
    """A price times scale, rounded half to even; 0 where there is no number."""
    return F.coalesce(F.rint(to_double(x) * scale).try_cast("long"), F.lit(0).cast("long"))


def positive_price(x: Column, scale: int = INDIA_SCALE) -> Column:
    """scale_price of positive numbers, 0 for all else."""
    return F.when(to_double(x) > 0, scale_price(x, scale)).otherwise(F.lit(0).cast("long"))


def lot_size(x: Column) -> Column:
    return F.coalesce(to_long(x), F.lit(1).cast("long"))


def cell_error(x: Column, scale: int | None = None) -> Column:
    """Why a cell gives no number, or with scale no price: null where it gives one, and where it is blank."""
    s, value = F.trim(F.coalesce(x.cast("string"), F.lit(""))), to_double(x)
    whole = F.rint(value * scale) if scale else value
    endless = F.lower(s).rlike("^[+-]?(nan|inf|infinity)$")
    return F.when(s == "", None).when(endless, "not finite").when(value.isNull(), "no number").when(whole.try_cast("long").isNull(), "out of range")


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)
