"""Raw rows to contracts: one projection for each feed, and bundles of markets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, expiry, numbers, sessions, symbols
from ..schema import CONTRACT_FIELDS, REQUIRED

#: Output exchange: the markets whose rows it bundles, in order.
BUNDLES = {"XNSE": ("XNSE", "XNFO", "XNCD"), "XBOM": ("XBSE", "XBFO"), "XIMC": ("XMCX",)}


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def contract(df: DataFrame, columns: dict, keep: list) -> DataFrame:
    """The 16 contract columns from the given expressions, null of the right type where there is none."""
    return df.select(*keep, *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t, _ in CONTRACT_FIELDS])


def normalize_india(master: DataFrame) -> DataFrame:
    """market, the rows' places in their files and the contract columns of master rows that have a script and a known market."""
    name = codes.instrument_name(F.col("exInstType"))
    script = _text("symTicker")
    session = sessions.with_pre_open(sessions.ist_sessions(F.col("tradingSession")), codes.segment_name(F.col("segment")))
    df = master.withColumn("market", codes.market(F.col("exchange"), F.col("segment"))).where((script != "") & (F.col("market") != ""))
    columns = {
        "scriptDetails": F.coalesce(F.nullif(F.col("symDetails"), F.lit("")), script), "scriptInstrumentType": name, "scriptInstrumentType2": codes.instrument_class(name), "multiplier": F.lit(numbers.INDIA_SCALE),
        "lotSize": numbers.lot_size(F.col("minLotSize")), "tickSize": numbers.scale_price(F.col("tickSize")), "ISIN": F.col("isin"), "tradingSessionUTC": session, "expiration": expiry.expiration_ns(F.col("expiryDate")),
        "script": script, "scriptToken": F.trim(F.col("exToken")).try_cast("long"), "underlying_root": _text("exSymName"), "underlying": _text("exSymName"), "strike": numbers.positive_price(F.col("strikePrice")),
        "optionType": codes.call_or_put(F.col("optType")), "currency": F.lit("INR"),
    }
    return contract(df, columns, ["market", *[c for c in ("source_path", "ordinal") if c in master.columns]])


#: Number cells of the Indian master, with the scale of those that are prices.
NUMBER_CELLS = {"minLotSize": None, "tickSize": numbers.INDIA_SCALE, "expiryDate": None, "exToken": None, "strikePrice": numbers.INDIA_SCALE}


def cell_errors(master: DataFrame, cells: dict = NUMBER_CELLS) -> DataFrame:
    """(source_path, ordinal, fyToken, errors) of rows with cells that normalize_india takes for nothing: errors has each one's column, raw text and reason.

    The rows stay in the normalized table, with 0, 1 or null there, as the feed's users expect; this is what tells such a value from a given one.
    """
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("raw"), numbers.cell_error(F.col(c), scale).alias("reason")) for c, scale in cells.items()])
    bad = master.withColumn("errors", F.filter(each, lambda e: e["reason"].isNotNull())).where(F.size("errors") > 0)
    return bad.select(*[c for c in ("source_path", "ordinal", "fyToken") if c in master.columns], "errors")


def bundle(rows: DataFrame, bundles: dict = BUNDLES) -> DataFrame:
    """exchange and source_ord in front: the bundle of each row's market and its place there; markets of no bundle go."""
    place = {m: (b, i) for b, ms in bundles.items() for i, m in enumerate(ms)}
    out = rows.withColumn("exchange", codes.lookup({m: b for m, (b, _) in place.items()}, F.col("market"))).withColumn("source_ord", codes.lookup({m: i for m, (_, i) in place.items()}, F.col("market")))
    return out.where(F.col("exchange").isNotNull())


def mapped_symbol() -> tuple[Column, Column]:
    """(symbol asked for, symbol of the contract): where the answer is an instrument id, the symbol is the one asked for."""
    asked = F.coalesce(F.nullif(F.col("stype_in_symbol"), F.lit("")), F.col("stype_in"), F.lit(""))
    answer = F.when(_text("stype_out") != "instrument_id", F.nullif(F.col("stype_out_symbol"), F.lit("")))
    return asked, F.coalesce(answer, asked)


def normalize_us(mappings: DataFrame, venue: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(contracts, quarantine) of one US venue's mappings; options with a date that does not exist are set apart with a reason."""
    asked, symbol = mapped_symbol()
    day = F.lit(as_of).cast("date")
    df = mappings.withColumns({"_asked": asked, "_symbol": symbol}).where(F.col("_symbol") != "")
    base = {"scriptDetails": F.col("_symbol"), "script": F.col("_symbol"), "scriptToken": F.col("instrument_id").try_cast("long"), "multiplier": F.lit(numbers.US_SCALE), "currency": F.lit("USD")}
    if venue == "XNAS":
        columns = base | {"scriptInstrumentType": F.lit("EQUITY"), "scriptInstrumentType2": F.lit("EQUITY"), "lotSize": F.lit(1), "strike": F.lit(0), "expiration": F.lit(0), "optionType": F.lit(""), "underlying": F.col("_symbol"), "underlying_root": symbols.symbol_root(F.col("_asked")), "tradingSessionUTC": sessions.us_session(day, "xnas")}
    elif venue == "XCME":
        df = df.withColumn("_x", symbols.future_or_option(F.col("_symbol"), F.year(day)))
        option = F.col("_x.option_type") != ""
        root = symbols.symbol_root(F.col("_asked"))
        columns = base | {"scriptInstrumentType": F.when(option, "OPTIDX").otherwise("FUTIDX"), "scriptInstrumentType2": F.when(option, "OPTION").otherwise("FUTURE"), "lotSize": F.lit(1), "strike": F.col("_x.strike"), "expiration": F.col("_x.expiration"), "optionType": F.col("_x.option_type"), "underlying": root, "underlying_root": root, "tradingSessionUTC": sessions.us_session(day, "xcme")}
    elif venue == "XCBO":
        df = df.withColumn("_x", symbols.occ(F.col("_symbol")))
        index = F.col("_x.is_index")
        columns = base | {"scriptInstrumentType": F.when(index, "OPTIDX").otherwise("OPTSTK"), "scriptInstrumentType2": F.lit("OPTION"), "lotSize": F.lit(100), "strike": F.col("_x.strike"), "expiration": F.col("_x.expiration"), "optionType": F.col("_x.option_type"), "underlying": F.col("_x.root"), "underlying_root": F.col("_x.root"), "tradingSessionUTC": F.when(index, sessions.us_session(day, "xcbo_index")).otherwise(sessions.us_session(day, "xcbo_equity"))}
    else:
        raise ValueError(f"no such venue: {venue}")
    out = contract(df, columns, [F.lit(venue).alias("exchange"), *[c for c in ("ordinal",) if c in mappings.columns]])
    bad = F.col("expiration").isNull()
    return out.where(~bad), out.where(bad).select(F.col("script").alias("record"), F.lit("expiration is no date").alias("reason"))


def split_invalid(contracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid with reason): rows that lack a required value."""
    lacks = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED if c in contracts.columns])
    return contracts.where(lacks == ""), contracts.where(lacks != "").withColumn("reason", F.concat(F.lit("no "), lacks))
