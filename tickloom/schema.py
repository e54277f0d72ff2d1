"""Column lists and types of the raw feeds and of the contract table."""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

#: Columns of the raw Indian master, in file order.
MASTER_COLUMNS = [
    "fyToken", "symDetails", "exInstType", "minLotSize", "tickSize", "isin", "tradingSession", "lastUpdate", "expiryDate", "symTicker", "exchange", "segment", "exToken", "exSymName",
    "underExToken", "strikePrice", "optType", "underFyTok", "underSym", "fyersExtra1", "fyersExtra2",
]
#: Older header names of them, lower-cased.
MASTER_ALIASES = {
    "fytoken": "fyToken", "symbol": "symDetails", "instrumenttype": "exInstType", "lotsize": "minLotSize", "isin": "isin", "symbolticker": "symTicker", "scriptcode": "exToken",
    "scripcode": "exToken", "scripname": "exSymName", "shortsym": "exSymName", "scriptoken": "underExToken", "optiontype": "optType", "underfytoken": "underFyTok", "underexsymbol": "underSym",
}
#: Columns of the raw US symbol mappings, and of the exchange's own file that are needed.
MAPPING_COLUMNS = ["instrument_id", "stype_in_symbol", "stype_out_symbol", "stype_in", "stype_out", "start_ts", "end_ts"]
EXCHANGE_FILE_COLUMNS = ["FinInstrmId", "TckrSymb", "XpryDt", "StrkPric", "OptnTp", "ISIN", "TickSz", "LotSz", "UndlyingSym", "UndlyingId"]

_TEXT, _LONG = StringType(), LongType()
#: The contract table without date and exchange: name, type, whether a value is required.
CONTRACT_FIELDS = [
    ("scriptDetails", _TEXT, True), ("scriptInstrumentType", _TEXT, True), ("scriptInstrumentType2", _TEXT, False), ("multiplier", _LONG, False), ("lotSize", _LONG, False), ("tickSize", _LONG, False),
    ("ISIN", _TEXT, False), ("tradingSessionUTC", _TEXT, True), ("expiration", _LONG, False), ("script", _TEXT, True), ("scriptToken", _LONG, True), ("underlying_root", _TEXT, True),
    ("underlying", _TEXT, True), ("strike", _LONG, False), ("optionType", _TEXT, False), ("currency", _TEXT, True),
]
CONTRACT_COLUMNS = [c for c, _, _ in CONTRACT_FIELDS]
REQUIRED = [c for c, _, required in CONTRACT_FIELDS if required]
#: Columns of the flat basket export.
BASKET_COLUMNS = ["date", "basket", "script", "scriptToken", "scriptInstrumentType2", "optionType", "underlying_root", "underlying", "strike", "expiration", "multiplier", "currency", "exchange"]


def texts(columns: list) -> StructType:
    return StructType([StructField(c, _TEXT) for c in columns])


#: Landed minute bars and option definitions.
BARS = StructType([StructField("ts", TimestampType()), *(StructField(c, DoubleType()) for c in ("open", "high", "low", "close")), StructField("volume", _LONG), StructField("underlying", _TEXT)])
DEFINITIONS = StructType([StructField("raw_symbol", _TEXT), StructField("strike_price", DoubleType()), StructField("expiration", TimestampType())])
