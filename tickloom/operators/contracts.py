"""The contract table: dated, deduplicated, live or near."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expiry import NS, day_start_ns
from ..schema import CONTRACT_COLUMNS
from ..sources.files import first_of


#: The order of the day's files and of the rows in them: by exchange, by place in its bundle, by file, by line.
FILE_ORDER = ["exchange", "source_ord", "source_path", "ordinal"]


def dated(rows: DataFrame, as_of: str) -> DataFrame:
    """date and exchange in front of the contract columns, for rows that have a token and an exchange."""
    keep = F.col("scriptToken").isNotNull() & (F.col("scriptToken").cast("string") != "") & (F.coalesce("exchange", F.lit("")) != "")
    extra = [c for c in FILE_ORDER[1:] if c in rows.columns]
    return rows.where(keep).select(F.lit(as_of).alias("date"), "exchange", *CONTRACT_COLUMNS, *extra)


def unique_contracts(rows: DataFrame, order: list, keys: tuple = ("scriptToken", "script")) -> DataFrame:
    """The first row of each token and script in the given total order, whatever its exchange."""
    return first_of(rows, list(keys), order)


def is_live(expiration: Column, as_of: str) -> Column:
    """Not expired before the day: what expires on it is live. On a stored column the bound reaches the scan."""
    return expiration >= day_start_ns(as_of)


def near_term(rows: DataFrame, as_of: str, days: int = 14, only_roots: list | None = None, expiration: str = "expiration", root: str = "underlying_root") -> DataFrame:
    """Rows without an expiration, or with one within so many days of as_of; only_roots: rows of other roots all stay."""
    e = F.col(expiration)
    near = e.isNull() | (e == 0) | (e <= day_start_ns(as_of) + days * 86_400 * NS)
    return rows.where(near | ~F.col(root).isin(only_roots) if only_roots else near)


def is_future() -> Column:
    return F.upper(F.trim(F.coalesce("scriptInstrumentType", F.lit("")))).startswith("FUT") | F.upper(F.trim(F.coalesce("script", F.lit("")))).endswith("FUT")


def is_option() -> Column:
    """Of rows that are no futures."""
    script = F.upper(F.trim(F.coalesce("script", F.lit(""))))
    named = (F.trim(F.coalesce("optionType", F.lit(""))) != "") | F.upper(F.trim(F.coalesce("scriptInstrumentType", F.lit("")))).startswith("OPT")
    return ~is_future() & (named | script.endswith("CE") | script.endswith("PE"))
