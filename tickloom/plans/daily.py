"""The daily flow as queries: raw files landed from the driver's tables, read, normalized, made contracts, resolved to baskets and exported.

Each line of lineitem is an instrument of part P<l_partkey>: equities, futures and options by line number, exchanges by order number.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, expiry, symbols
from ..operators import bars, baskets, contracts, normalize, sinks, store
from ..schema import BASKET_COLUMNS, CONTRACT_COLUMNS, MASTER_COLUMNS
from ..scratch import discard, kept, scratch_dir, shuffles_dropped, watch
from ..sources import files
from ..streaming import intake
from .registry import query, table, ticks

DAY = "20260728"
LIVE = "19980101"
C = F.col


#: The order of the master's lines, over files whose names rise.
LANDED = ["l_suppkey", "l_extendedprice", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"]
_LANDED = ", ".join(LANDED)
#: How large CSV files are written: compressed, the fast way, and in pieces, as such a file cannot be split among tasks.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def landed_master(spark: SparkSession, sf_dir: str) -> str:
    """The raw master as a CSV folder without a header."""
    m, k = C("l_linenumber"), C("l_orderkey") % 8
    kind = F.when(m.isin(3, 4), "F").when(m.isin(5, 6), "O").otherwise("E")
    ex = F.when(k < 4, "NSE").when(k < 6, "BSE").when(k == 6, "MCX").otherwise("XXX")
    root, seconds = F.concat(F.lit("P"), C("l_partkey")), F.unix_seconds(C("l_shipdate").cast("timestamp"))
    month = F.upper(F.date_format("l_shipdate", "yyMMM"))
    ticker = F.when(kind == "E", F.lit("-EQ")).when(kind == "F", F.concat(month, F.lit("FUT"))).otherwise(F.concat(month, F.floor("l_extendedprice").cast("string"), F.when(C("l_returnflag") == "R", "CE").otherwise("PE")))
    values = {
        "symDetails": F.when(C("l_quantity") % 2 == 0, "").otherwise(F.concat(F.lit("Details "), root, F.lit(', "'), m, F.lit('"'))), "exInstType": F.when(m == 2, " 99").when(kind == "E", "0").when(kind == "F", F.when(ex == "MCX", "30").otherwise("13")).otherwise(F.when(ex == "MCX", "31").otherwise("15")),
        "minLotSize": F.when(m == 7, "").otherwise(C("l_quantity").cast("int").cast("string")), "tickSize": F.when(m == 1, "bad").otherwise("0.05"), "isin": F.concat(F.lit("INE"), C("l_suppkey")),
        "tradingSession": F.when(kind == "E", "0915-1530|1815-1915:").when(kind == "F", "0915-1530:").when(m == 6, "2400-2500").otherwise("0900-2330:"), "expiryDate": F.when(kind == "E", "").when(m == 6, (seconds * 1_000_000_000).cast("string")).otherwise(seconds.cast("string")),
        "symTicker": F.when(C("l_quantity") == 1, "").otherwise(F.concat(ex, F.lit(":"), root, ticker)), "exchange": F.when(ex == "NSE", "10").when(ex == "BSE", "12").when(ex == "MCX", "11").otherwise("99"), "segment": F.when(ex == "MCX", "20").when(kind == "E", "10").otherwise("11"),
        "exToken": F.concat(F.lit(" "), C("l_partkey")), "exSymName": root, "strikePrice": F.when(kind == "O", C("l_extendedprice").cast("decimal(12,2)").cast("string")).otherwise("-1.0"), "optType": F.when(kind == "O", F.when(C("l_returnflag") == "R", "CE").otherwise("pe ")).otherwise("XX"),
    }
    path = f"{scratch_dir(spark)}/master"
    rows = table(spark, sf_dir, "lineitem").orderBy(*LANDED)
    with shuffles_dropped(spark):
        rows.select(*[values.get(c, F.lit("")).alias(c) for c in MASTER_COLUMNS]).write.options(escape='"', **PACKED).csv(path)
    return path


def india(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed master's rows, normalized; its files go when their lines have been read."""
    landed = landed_master(spark, sf_dir)
    good, _ = files.read_master(spark, landed)
    discard(spark, landed)
    return normalize.normalize_india(good)


_COLS = ", ".join(CONTRACT_COLUMNS)


def day_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's contracts: bundled, dated, the first of each token and script in the files' order."""
    return contracts.unique_contracts(contracts.dated(normalize.bundle(india(spark, sf_dir)), DAY), contracts.FILE_ORDER)


_INDIA = f"""r AS (SELECT *, 'P' || l_partkey AS root, CASE WHEN l_linenumber IN (3, 4) THEN 'F' WHEN l_linenumber IN (5, 6) THEN 'O' ELSE 'E' END AS kind,
  ['NSE', 'NSE', 'NSE', 'NSE', 'BSE', 'BSE', 'MCX', 'XXX'][1 + l_orderkey % 8] AS ex FROM lineitem WHERE l_quantity <> 1),
n0 AS (SELECT *, CASE ex WHEN 'NSE' THEN CASE kind WHEN 'E' THEN 'XNSE' ELSE 'XNFO' END WHEN 'BSE' THEN CASE kind WHEN 'E' THEN 'XBSE' ELSE 'XBFO' END WHEN 'MCX' THEN 'XMCX' END AS market,
  ex || ':' || root || CASE kind WHEN 'E' THEN '-EQ' ELSE strftime(l_shipdate, '%y') || upper(strftime(l_shipdate, '%b')) || CASE kind WHEN 'F' THEN 'FUT' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || CASE l_returnflag WHEN 'R' THEN 'CE' ELSE 'PE' END END END AS script FROM r),
n AS (SELECT {_LANDED}, market, CASE WHEN l_quantity % 2 = 0 THEN script ELSE 'Details ' || root || ', "' || l_linenumber || '"' END AS scriptDetails,
  CASE WHEN l_linenumber = 2 THEN 'UNKNOWN_99' WHEN kind = 'E' THEN 'EQ' WHEN kind = 'F' THEN CASE ex WHEN 'MCX' THEN 'FUTCOM' ELSE 'FUTSTK' END ELSE CASE ex WHEN 'MCX' THEN 'OPTFUT' ELSE 'OPTSTK' END END AS scriptInstrumentType,
  CASE WHEN l_linenumber = 2 THEN 'UNKNOWN_99' WHEN kind = 'E' THEN 'EQUITY' WHEN kind = 'F' THEN 'FUTURE' ELSE 'OPTION' END AS scriptInstrumentType2, CAST(100 AS BIGINT) AS multiplier,
  CASE WHEN l_linenumber = 7 THEN 1 ELSE CAST(l_quantity AS BIGINT) END AS lotSize, CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE 5 END AS BIGINT) AS tickSize, 'INE' || l_suppkey AS ISIN,
  CASE WHEN kind = 'E' THEN CASE WHEN ex = 'MCX' THEN '' ELSE '0330-0338|' END || '0345-1000|1245-1345' WHEN kind = 'F' THEN '0345-1000' WHEN l_linenumber = 6 THEN '' ELSE '0330-1800' END AS tradingSessionUTC,
  CASE WHEN kind = 'E' THEN 0 ELSE epoch_us(l_shipdate) * 1000 END AS expiration, script, l_partkey AS scriptToken, root AS underlying_root, root AS underlying,
  CASE WHEN kind = 'O' THEN CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) ELSE 0 END AS strike, CASE WHEN kind <> 'O' THEN '' WHEN l_returnflag = 'R' THEN 'CALL' ELSE 'PUT' END AS optionType, 'INR' AS currency FROM n0 WHERE market IS NOT NULL)"""
_ORDER = f"exchange, source_ord, {_LANDED}"
_DAY = f"""{_INDIA}, e AS (SELECT CASE WHEN market IN ('XNSE', 'XNFO') THEN 'XNSE' WHEN market = 'XMCX' THEN 'XIMC' ELSE 'XBOM' END AS exchange, CASE WHEN market IN ('XNFO', 'XBFO') THEN 1 ELSE 0 END AS source_ord, * EXCLUDE (market) FROM n),
d AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY scriptToken, script ORDER BY {_ORDER}) = 1)"""


@query(f"WITH {_INDIA} SELECT market, {_COLS} FROM n")
def normalize_india(spark, sf_dir):
    """Rows of a raw master file in the contract's columns, of those with a script and a known market."""
    return india(spark, sf_dir).select("market", *CONTRACT_COLUMNS)


@query(f"WITH {_DAY} SELECT '{DAY}' AS date, exchange, {_COLS} FROM d")
def daily_contracts(spark, sf_dir):
    """The day's contracts of all exchanges."""
    return day_contracts(spark, sf_dir).select("date", "exchange", *CONTRACT_COLUMNS)


@query(f"WITH {_DAY} SELECT exchange, {_COLS} FROM d")
def contracts_export(spark, sf_dir):
    """Valid contracts written as compressed CSV by exchange, and read back with their types; what the export was made from goes before it is read."""
    path = f"{scratch_dir(spark)}/normalized"
    with watch() as made, shuffles_dropped(spark):
        valid, _ = normalize.split_invalid(day_contracts(spark, sf_dir))
        sinks.write_partitions(valid.select("exchange", *CONTRACT_COLUMNS), path, ["exchange"], ["script"], kind="csv", every=[(b,) for b in normalize.BUNDLES], **PACKED)
    discard(spark, *made)
    return files.read_normalized(spark, path).select("exchange", *CONTRACT_COLUMNS)


#: Headers of landed files by form: none, names by which columns were known, and this library's names in another order among others.
_OLDER = "FyToken,Symbol,InstrumentType,SymbolTicker,exchange,segment,ShortSym"
_OTHER = '"ISIN",note,exsymname,symTicker,FYTOKEN,symDetails,symTicker'


def landed_forms(spark: SparkSession, sf_dir: str) -> str:
    """A folder of twelve files of four forms: without a header, with an older one, with a byte order mark, CRLF and quotes, and with a blank line in front; some lines are bad."""
    k = C("p_partkey")
    rows = table(spark, sf_dir, "part").select(k, (k % 4).alias("form"), (F.floor(k / 4) % 3).alias("batch"), F.concat(F.lit("NSE:P"), k, F.lit("-EQ")).alias("ticker"))
    fixed = lambda n: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i == 0, k.cast("string")).when(i == 1, F.concat(F.lit("name "), k)).when(i == 9, C("ticker")).when(i == 13, F.concat(F.lit("P"), k)).otherwise("")), ",")
    older = F.concat_ws(",", k, F.concat(F.lit("name "), k), F.lit("0"), C("ticker"), F.lit("10"), F.lit("10"), F.concat(F.lit("P"), k), F.when(k % 20 == 1, "more"))
    other = F.concat(F.lit("INE,x,P"), k, F.lit(",first,"), k, F.lit(',"name ""A, '), k, F.lit('""",'), C("ticker"), F.lit("\r"))
    line = F.when(C("form") == 0, fixed(21)).when(C("form") == 1, older).when(C("form") == 2, other).when(k % 16 == 3, fixed(10)).when(k % 16 == 7, fixed(22)).otherwise(fixed(21))
    head = F.when(C("form") == 1, _OLDER).when(C("form") == 2, f"\ufeff{_OTHER}\r").when(C("form") == 3, "  ")
    heads = rows.select("form", "batch").distinct().where("form > 0").select("form", "batch", F.lit(-1).cast("long").alias("p_partkey"), head.alias("line"))
    path = f"{scratch_dir(spark)}/forms"
    every = heads.unionByName(rows.select("form", "batch", "p_partkey", line.alias("line"))).repartition("form", "batch").sortWithinPartitions("form", "batch", "p_partkey")
    every.select("form", "batch", "line").write.partitionBy("form", "batch").text(path)
    return path


@query("""
WITH p AS (SELECT p_partkey AS k, p_partkey % 4 AS form, (p_partkey // 4) % 3 AS batch, row_number() OVER (PARTITION BY p_partkey % 4, (p_partkey // 4) % 3 ORDER BY p_partkey) - (p_partkey % 4 = 0)::INT AS ordinal FROM part),
b AS (SELECT *, CASE WHEN form = 1 AND k % 20 = 1 THEN 8 WHEN k % 16 = 3 THEN 10 WHEN k % 16 = 7 THEN 22 END AS n FROM p)
SELECT form::INT AS form, batch::INT AS batch, ordinal::BIGINT AS ordinal, CASE WHEN n IS NULL THEN k::VARCHAR END AS fyToken, CASE WHEN n IS NULL THEN CASE form WHEN 2 THEN 'name "A, ' || k || '"' ELSE 'name ' || k END END AS symDetails,
  CASE WHEN n IS NULL THEN 'NSE:P' || k || '-EQ' END AS symTicker, CASE WHEN n IS NULL THEN 'P' || k END AS exSymName, CASE WHEN n IS NULL AND form = 2 THEN 'INE' END AS isin, CASE WHEN n = 8 THEN 8 WHEN n = 10 THEN 3 WHEN n = 22 THEN 4 END AS filled,
  CASE n WHEN 8 THEN concat_ws(',', k, 'name ' || k, '0', 'NSE:P' || k || '-EQ', '10', '10', 'P' || k, 'more') WHEN 10 THEN k || ',name ' || k || ',,,,,,,,NSE:P' || k || '-EQ' WHEN 22 THEN k || ',name ' || k || ',,,,,,,,NSE:P' || k || '-EQ,,,,P' || k || ',,,,,,,,' END AS record
FROM b""")
def mixed_masters(spark, sf_dir):
    """A folder of raw files of several forms: each row with its file and line, and each bad line with its own."""
    good, bad = files.read_master(spark, landed_forms(spark, sf_dir))
    where = [F.regexp_extract("source_path", rf"/{c}=(\d+)/", 1).cast("int").alias(c) for c in ("form", "batch")]
    cells = ["fyToken", "symDetails", "symTicker", "exSymName", "isin"]
    both = good.select(*where, "ordinal", *cells).unionByName(bad.select(*where, C("line_no").alias("ordinal"), "filled", "record"), allowMissingColumns=True)
    return both.select("form", "batch", "ordinal", *cells, "filled", "record")


_BAD = ["", "12", " 7.9 ", "nan", "-Inf", "1e30", "1.5d", "0x1F", "+.5", "9223372036854775000", "12,5", "4e16"]
_REASONS = {"nan": "not finite", "-Inf": "not finite", "1e30": "out of range", "1.5d": "no number", "0x1F": "no number", "12,5": "no number"}


@query(f"""
WITH v AS (SELECT {_BAD} AS texts, MAP {{{', '.join(f"'{k}': '{v}'" for k, v in _REASONS.items())}}} AS why),
o AS (SELECT o_orderkey AS k, o_custkey AS c, texts, why, texts[1 + o_orderkey % 12] AS lot, texts[1 + o_custkey % 12] AS tick, texts[1 + (o_orderkey // 12) % 12] AS strike, texts[1 + (o_custkey // 12) % 12] AS token FROM orders, v),
e AS (SELECT k, 'minLotSize' AS "column", lot AS raw, why[lot] AS reason FROM o UNION ALL SELECT k, 'tickSize', tick, CASE WHEN tick = '9223372036854775000' THEN 'out of range' ELSE why[tick] END FROM o
  UNION ALL SELECT k, 'strikePrice', strike, CASE WHEN strike = '9223372036854775000' THEN 'out of range' ELSE why[strike] END FROM o UNION ALL SELECT k, 'exToken', token, why[token] FROM o)
SELECT k::VARCHAR AS fyToken, "column", raw, reason FROM e WHERE reason IS NOT NULL""")
def master_cell_errors(spark, sf_dir):
    """Cells of a raw master that are no numbers: column, text and reason of each."""
    text = lambda k: F.element_at(F.array(*map(F.lit, _BAD)), (1 + k % len(_BAD)).cast("int"))
    k, c = C("o_orderkey"), C("o_custkey")
    values = {"fyToken": k.cast("string"), "minLotSize": text(k), "tickSize": text(c), "strikePrice": text(F.floor(k / 12)), "exToken": text(F.floor(c / 12))}
    path = f"{scratch_dir(spark)}/cells"
    table(spark, sf_dir, "orders").select(*[values.get(x, F.lit("")).alias(x) for x in MASTER_COLUMNS]).write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    bad = normalize.cell_errors(files.read_master(spark, path)[0])
    return bad.select("fyToken", F.inline("errors"))


@query(f"""
WITH o AS (SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE o_orderkey::VARCHAR END AS token FROM orders WHERE o_orderkey % 7 <> 3 AND o_orderkey % 11 <> 5)
SELECT 'NSE:O' || k AS script, CASE WHEN token IN ('', 'x') THEN 'no scriptToken' ELSE '' END AS reason, CASE WHEN token NOT IN ('', 'x') THEN '{DAY}' END AS date FROM o""")
def contract_halves(spark, sf_dir):
    """Instruments of all orders: the valid and the invalid ones with what they lack, and which of them the day's contracts keep; those without a script or a known market are none."""
    k = C("o_orderkey")
    values = {
        "fyToken": k.cast("string"), "symTicker": F.when(k % 7 == 3, "").otherwise(F.concat(F.lit("NSE:O"), k)), "exchange": F.when(k % 11 == 5, "77").otherwise("10"), "segment": F.lit("10"), "exInstType": F.lit("0"),
        "exToken": F.when(k % 6 == 0, "").when(k % 6 == 1, "x").otherwise(k.cast("string")), "exSymName": F.lit("O"),
    }
    path = f"{scratch_dir(spark)}/halves"
    table(spark, sf_dir, "orders").select(*[values.get(c, F.lit("")).alias(c) for c in MASTER_COLUMNS]).write.csv(path)
    rows = normalize.bundle(normalize.normalize_india(files.read_master(spark, path)[0]))
    valid, invalid = normalize.split_invalid(rows)
    both = valid.select("script", F.lit("").alias("reason")).unionByName(invalid.select("script", "reason"))
    return both.join(contracts.dated(rows, DAY).select("script", "date"), "script", "left")


@query("""
WITH l AS (SELECT p_partkey, p_partkey % 3 AS k, array_to_string(list_transform(range(CASE p_partkey % 3 WHEN 0 THEN 21 WHEN 1 THEN 22 ELSE 10 END), lambda i: p_partkey || 'c' || i), ',') AS record FROM part)
SELECT record, 'wrong number of cells' AS reason FROM l WHERE k <> 0""")
def master_quarantine(spark, sf_dir):
    """The lines of a raw master that have too many or too few cells."""
    k = C("p_partkey")
    n = F.when(k % 3 == 0, 21).when(k % 3 == 1, 22).otherwise(10)
    line = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(k.cast("string"), F.lit("c"), i.cast("string"))), ",")
    path = f"{scratch_dir(spark)}/lines"
    table(spark, sf_dir, "part").select(line).write.text(path)
    return files.read_master(spark, path)[1].select("record", "reason")


#: The templates that the baskets read, and the form of their lines.
TEMPLATES = [
    ("XNSE_NIFTYFNO_EQUITY", "NSE:", "-EQ"), ("XNSE_INDEX_FUTURES_NEAR", "NSE:", "26JULFUT"), ("XNSE_INDEX_FUTURES_ALL", "NSE:", "26JULFUT"), ("XBOM_INDEX_FUTURES", "BSE:", "26JULFUT"), ("XIMC_FUTURES_ALL", "MCX:", "26AUGFUT"),
    ("XIMC_CRUDE_NEAREST_NXTNEAREST", "MCX:", "26AUG100.25CE"), ("XIMC_BULLDEX_NEAREST_NXTNEAREST", "MCX:", "26AUG29000PE"), ("XNSE_NIFTY50_EQUITY", "NSE:", "-EQ"), ("XNSE_NIFTY100_EQUITY", "NSE:", "-EQ"), ("XNSE_NIFTY200_EQUITY", "NSE:", "-EQ"),
    ("XNSE_NIFTY500_EQUITY", "NSE:", "-EQ"),
]


def landed_templates(spark: SparkSession, sf_dir: str) -> str:
    """Every part is in the list that its size says; a list has a comment, a blank line, its parts, and its first line again."""
    forms = F.array(*[F.struct(*map(F.lit, t)) for t in TEMPLATES])
    form = F.element_at(forms, (1 + C("p_size") % len(TEMPLATES)).cast("int"))
    line = F.concat(form["col2"], F.lit("P"), C("p_partkey"), form["col3"])
    lists = table(spark, sf_dir, "part").groupBy(form["col1"].alias("name")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))).alias("v"))
    path = f"{scratch_dir(spark)}/templates"
    lists.select("name", F.concat(F.lit("# a list\n\n"), F.array_join(F.transform("v", lambda x: x["line"]), "\n"), F.lit("\n "), C("v")[0]["line"])).write.partitionBy("name").text(path)
    return path


def all_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 baskets of the day, from one reading of the normalized rows and one of the templates; a row that repeats stands in a basket as often."""
    lists = files.read_lines(spark, landed_templates(spark, sf_dir))
    return baskets.resolve([*baskets.BASKETS, *baskets.UNIONS], lists, normalize.bundle(india(spark, sf_dir)), LIVE, contracts.FILE_ORDER)


_NAMES = ", ".join(f"('{n}', '{p}', '{s}', {i})" for i, (n, p, s) in enumerate(TEMPLATES))
_BASKETS = f"""{_DAY}, t0 AS (SELECT name, p_partkey, prefix || 'P' || p_partkey || suffix AS script, 'P' || p_partkey AS root, 1 + row_number() OVER (PARTITION BY name ORDER BY p_partkey) AS ordinal
  FROM part JOIN (VALUES {_NAMES}) AS v(name, prefix, suffix, i) ON i = p_size % {len(TEMPLATES)}),
t AS (SELECT name, script, root, ordinal FROM t0 UNION ALL SELECT name, arg_min(script, ordinal), arg_min(root, ordinal), max(ordinal) + 1 FROM t0 GROUP BY 1),
by_script AS (SELECT t.name AS basket, t.ordinal AS root_ordinal, e.* FROM t JOIN e USING (script) WHERE e.exchange = 'XNSE' AND t.name LIKE '%EQUITY'
  QUALIFY row_number() OVER (PARTITION BY t.name, t.ordinal ORDER BY {', '.join(f'{c} DESC' for c in _ORDER.split(', '))}) = 1),
roots AS (SELECT name, root, min(ordinal) AS root_ordinal FROM t GROUP BY 1, 2),
live AS (SELECT * FROM e WHERE expiration >= 883612800000000000),
futures AS (SELECT name, root_ordinal, l.* FROM roots JOIN live l ON l.underlying_root = root WHERE scriptInstrumentType LIKE 'FUT%'),
near AS (SELECT * FROM futures QUALIFY row_number() OVER (PARTITION BY name, exchange, root_ordinal ORDER BY expiration, {_ORDER}) = 1),
chain AS (SELECT name, root_ordinal, l.* FROM roots JOIN live l ON l.underlying_root = root WHERE exchange = 'XIMC' AND scriptInstrumentType LIKE 'OPT%' QUALIFY dense_rank() OVER (PARTITION BY name, root_ordinal ORDER BY expiration) <= 2),
index_parts AS (SELECT * FROM near WHERE name = 'XNSE_INDEX_FUTURES_NEAR' AND exchange = 'XNSE' UNION ALL SELECT * FROM near WHERE name = 'XBOM_INDEX_FUTURES' AND exchange = 'XBOM' UNION ALL SELECT * FROM futures WHERE name = 'XIMC_FUTURES_ALL' AND exchange = 'XIMC'),
b AS (SELECT * FROM by_script UNION ALL SELECT 'XNSE_NIFTYFNO_FUTURES_NEAR', * EXCLUDE (name) FROM near WHERE name = 'XNSE_NIFTYFNO_EQUITY' AND exchange = 'XNSE' UNION ALL SELECT 'XNSE_NIFTYFNO_FUTURES_ALL', * EXCLUDE (name) FROM futures WHERE name = 'XNSE_NIFTYFNO_EQUITY' AND exchange = 'XNSE'
  UNION ALL SELECT 'XNSE_NIFTY500_FUTURES', * EXCLUDE (name) FROM futures WHERE name = 'XNSE_NIFTY500_EQUITY' AND exchange = 'XNSE' UNION ALL SELECT * FROM futures WHERE name = 'XNSE_INDEX_FUTURES_ALL' AND exchange = 'XNSE'
  UNION ALL SELECT * FROM index_parts UNION ALL SELECT 'ALL_INDEX_FUTURES', * EXCLUDE (name) FROM index_parts UNION ALL SELECT * FROM chain WHERE name LIKE 'XIMC%NEAREST')"""


@query(f"WITH {_BASKETS} SELECT basket, CAST(root_ordinal AS INT) AS root_ordinal, exchange, {_COLS} FROM b")
def daily_baskets(spark, sf_dir):
    """The constituents of all 15 baskets."""
    return all_baskets(spark, sf_dir).select("basket", "root_ordinal", "exchange", *CONTRACT_COLUMNS)


_FLAT = [c for c in BASKET_COLUMNS if c not in ("date", "basket")]


@query(f"WITH {_BASKETS} SELECT basket, '{DAY}' AS date, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _FLAT)} FROM b")
def baskets_export(spark, sf_dir):
    """The flat baskets written as CSV, a folder for each, and read back as text."""
    path = scratch_dir(spark)
    rows = all_baskets(spark, sf_dir)
    sinks.write_baskets(baskets.flat(rows, DAY, BASKET_COLUMNS), path, DAY)
    return files.read_baskets(spark, f"{path}/date={DAY}", _FLAT).select("basket", F.lit(DAY).alias("date"), *_FLAT)


@query(f"WITH {_BASKETS} SELECT basket, to_json(list(script ORDER BY root_ordinal, expiration, script)) AS scripts FROM b GROUP BY 1")
def basket_table(spark, sf_dir):
    """One row for each basket: its scripts as a JSON array, by template line, expiration and script."""
    return baskets.documents(all_baskets(spark, sf_dir), "basket", "script", [C("root_ordinal"), C("expiration"), C("script")])


_MONTHS = symbols.MONTH_CODES


def landed_mappings(spark: SparkSession, sf_dir: str, venue: int) -> str:
    """Symbol mappings of one venue from all orders: the symbol asked for, or the venue's answer where that is no instrument id."""
    k, price, date = C("o_orderkey"), F.floor("o_totalprice").cast("string"), C("o_orderdate")
    if venue == 0:
        base = F.concat(F.lit("ES"), F.substring(F.lit(_MONTHS), F.month(date), F.lit(1)), (k % 10).cast("string"))
        symbol = F.when(k % 4 == 1, F.concat(base, F.lit(" P"), price)).when(k % 4 == 2, F.concat(base, F.lit(" C"), price, F.lit(".5"))).when(k % 4 == 3, "ES.OPT").otherwise(base)
    elif venue == 1:
        digits = F.concat(F.date_format(date, "yy"), F.when(k % 17 == 0, "1315").otherwise(F.date_format(date, "MMdd")))
        symbol = F.when(k % 5 == 4, "NVDA.OPT").otherwise(F.concat(F.rpad(F.when(k % 2 == 0, "SPXW").otherwise("nvda"), 6, " "), digits, F.when(k % 3 == 0, "C").otherwise("P"), F.lpad(price, 8, "0")))
    else:
        symbol = F.element_at(F.array(*map(F.lit, ["NVDA", "BRK.B", "NA", ".SPX"])), (1 + k % 4).cast("int"))
    how = k % 3
    columns = {"instrument_id": k.cast("string"), "stype_in_symbol": F.when(how == 0, symbol).when(how == 1, "").otherwise("asked"), "stype_in": F.when(how == 1, symbol).otherwise("parent"), "stype_out_symbol": F.when(how == 2, symbol).otherwise(k.cast("string")), "stype_out": F.when(how == 2, "raw_symbol").otherwise("instrument_id")}
    path = f"{scratch_dir(spark)}/mappings"
    rows = table(spark, sf_dir, "orders")
    rows.select(*[columns.get(c, F.lit("")).alias(c) for c in files.MAPPING_COLUMNS]).write.options(header=True, escape='"').csv(path)
    return path


VENUES = ("XCME", "XCBO", "XNAS")
US = ["exchange", *[c for c in CONTRACT_COLUMNS if c not in ("tickSize", "ISIN")]]


def us(spark: SparkSession, sf_dir: str, venue: str) -> tuple[DataFrame, DataFrame]:
    good, _ = files.read_mappings(spark, landed_mappings(spark, sf_dir, VENUES.index(venue)))
    return normalize.normalize_us(good, venue, "2026-07-28")


_ROOT = "CASE WHEN how = 2 THEN 'asked' WHEN symbol LIKE '.%' THEN symbol[2:] WHEN regexp_matches(symbol, '^[A-Z]') THEN regexp_extract(symbol, '^[A-Z]+') ELSE symbol END"
_BOOK = "symbol AS scriptDetails, symbol AS script, o_orderkey AS scriptToken, CAST(1000000000 AS BIGINT) AS multiplier, 'USD' AS currency"
_XCME = f"""o AS (SELECT *, o_orderkey % 4 AS kind, o_orderkey % 3 AS how, CAST(floor(o_totalprice) AS BIGINT) AS k, 'ES' || '{_MONTHS}'[month(o_orderdate)] || o_orderkey % 10 AS base FROM orders),
s AS (SELECT *, CASE kind WHEN 1 THEN base || ' P' || k WHEN 2 THEN base || ' C' || k || '.5' WHEN 3 THEN 'ES.OPT' ELSE base END AS symbol, 2020 + o_orderkey % 10 + CASE WHEN o_orderkey % 10 < 1 THEN 10 ELSE 0 END AS y FROM o)
SELECT 'XCME' AS exchange, {_BOOK}, CASE WHEN kind IN (1, 2) THEN 'OPTIDX' ELSE 'FUTIDX' END AS scriptInstrumentType, CASE WHEN kind IN (1, 2) THEN 'OPTION' ELSE 'FUTURE' END AS scriptInstrumentType2, CAST(1 AS BIGINT) AS lotSize,
  '2200-1330|1330-2015|2015-2100' AS tradingSessionUTC, CASE WHEN kind = 3 THEN 0 ELSE epoch_us(make_date(y, month(o_orderdate), 1)::TIMESTAMP) * 1000 END AS expiration, {_ROOT} AS underlying_root, {_ROOT} AS underlying,
  CASE kind WHEN 1 THEN k * 1000000000 WHEN 2 THEN k * 1000000000 + 500000000 ELSE 0 END AS strike, CASE kind WHEN 1 THEN 'PUT' WHEN 2 THEN 'CALL' ELSE '' END AS optionType FROM s"""
_XCBO_S = """o AS (SELECT *, o_orderkey % 3 AS how, lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), 8, '0') AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'SPXW' ELSE 'NVDA' END AS root, o_orderkey % 5 = 4 AS bare FROM orders),
s AS (SELECT *, CASE WHEN bare THEN 'NVDA.OPT' ELSE rpad(CASE root WHEN 'NVDA' THEN 'nvda' ELSE root END, 6, ' ') || strftime(o_orderdate, '%y') || CASE WHEN o_orderkey % 17 = 0 THEN '1315' ELSE strftime(o_orderdate, '%m%d') END || CASE WHEN o_orderkey % 3 = 0 THEN 'C' ELSE 'P' END || k END AS symbol FROM o)"""
_XCBO = f"""{_XCBO_S} SELECT 'XCBO' AS exchange, {_BOOK}, CASE WHEN NOT bare AND root = 'SPXW' THEN 'OPTIDX' ELSE 'OPTSTK' END AS scriptInstrumentType, 'OPTION' AS scriptInstrumentType2, CAST(100 AS BIGINT) AS lotSize,
  CASE WHEN NOT bare AND root = 'SPXW' THEN '0015-1325|1330-2015|2015-2100' ELSE '1130-1325|1330-2000|2000-2015' END AS tradingSessionUTC,
  CASE WHEN bare THEN 0 ELSE epoch_us((CAST(o_orderdate AS DATE) + CASE root WHEN 'SPXW' THEN TIME '17:00:00' ELSE TIME '16:15:00' END) AT TIME ZONE 'America/New_York') * 1000 END AS expiration,
  CASE WHEN bare THEN '' ELSE root END AS underlying_root, CASE WHEN bare THEN '' ELSE root END AS underlying, CASE WHEN bare THEN 0 ELSE CAST(k AS BIGINT) * 1000000 END AS strike, CASE WHEN bare THEN '' WHEN o_orderkey % 3 = 0 THEN 'CALL' ELSE 'PUT' END AS optionType
  FROM s WHERE bare OR o_orderkey % 17 <> 0"""
_XNAS = f"""s AS (SELECT *, o_orderkey % 3 AS how, ['NVDA', 'BRK.B', 'NA', '.SPX'][1 + o_orderkey % 4] AS symbol FROM orders)
SELECT 'XNAS' AS exchange, {_BOOK}, 'EQUITY' AS scriptInstrumentType, 'EQUITY' AS scriptInstrumentType2, CAST(1 AS BIGINT) AS lotSize, '0800-1330|1330-2000|2000-0000' AS tradingSessionUTC, CAST(0 AS BIGINT) AS expiration, {_ROOT} AS underlying_root, symbol AS underlying, CAST(0 AS BIGINT) AS strike, '' AS optionType FROM s"""


@query(f"WITH {_XCME}")
def normalize_us_futures(spark, sf_dir):
    """Futures and their options of one US venue from its symbol mappings."""
    return us(spark, sf_dir, "XCME")[0].select(US)


@query(f"WITH {_XCBO}")
def normalize_us_options(spark, sf_dir):
    """Options of stocks and indices, of those whose date exists."""
    return us(spark, sf_dir, "XCBO")[0].select(US)


@query(f"WITH {_XNAS}")
def normalize_us_equities(spark, sf_dir):
    """Equities; NA stays a symbol."""
    return us(spark, sf_dir, "XNAS")[0].select(US)


@query(f"WITH {_XCBO_S} SELECT symbol AS record, 'expiration is no date' AS reason FROM s WHERE NOT bare AND o_orderkey % 17 = 0")
def us_quarantine(spark, sf_dir):
    """Option symbols whose date does not exist."""
    return us(spark, sf_dir, "XCBO")[1]


@query(f"WITH {_XNAS}")
def mapping_stream(spark, sf_dir):
    """Mappings that landed as files, taken in by a stream into partitions of a day and batch."""
    landed, out = landed_mappings(spark, sf_dir, 2), scratch_dir(spark)
    stream = intake.read_mapping_stream(spark, landed)
    intake.take_in(stream, f"{out}/checkpoint", intake.contracts_sink(f"{out}/contracts", "XNAS", "2026-07-28")).awaitTermination()
    return spark.read.parquet(f"{out}/contracts").select(US)


#: Rows that the capture takes of a symbol, and the seconds from its first one.
CAP, LIVE_SECONDS = 12, 500 * 86_400


@query(f"""
WITH o AS (SELECT 'S' || o_custkey % 40 AS symbol, o_orderkey AS id, o_orderdate AS ts, o_orderkey % 7 = 0 AS failed FROM orders),
g AS (SELECT symbol, id, row_number() OVER (PARTITION BY symbol ORDER BY ts, id) AS n, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY symbol) AS since FROM o WHERE NOT failed)
SELECT symbol, id::VARCHAR AS instrument_id, '' AS reason FROM g WHERE n <= {CAP} AND since < {LIVE_SECONDS} * 1000000::BIGINT
UNION ALL SELECT symbol, '', 'no instrument' FROM o WHERE failed""")
def captured_mappings(spark, sf_dir):
    """Mappings that landed in three parts, each taken in by a stream started anew: so many of a symbol at most, in so many seconds; those without an instrument are set apart."""
    k, date = C("o_orderkey"), C("o_orderdate")
    columns = {"instrument_id": F.when(k % 7 == 0, "").otherwise(F.lpad(k.cast("string"), 12, "0")), "stype_in_symbol": F.concat(F.lit("S"), C("o_custkey") % 40), "start_ts": F.date_format(date, "yyyy-MM-dd HH:mm:ss")}
    landed, out, rows = f"{scratch_dir(spark)}/mappings", scratch_dir(spark), table(spark, sf_dir, "orders")
    for since, until in (("1900", "1994"), ("1994", "1996"), ("1996", "2100")):
        part = rows.where((F.year(date) >= int(since)) & (F.year(date) < int(until)))
        part.select(*[columns.get(c, F.lit("")).alias(c) for c in files.MAPPING_COLUMNS]).write.mode("append").options(header=True, escape='"').csv(landed)
        some = intake.captured(intake.read_mapping_stream(spark, landed), CAP, LIVE_SECONDS)
        intake.take_in(some, f"{out}/checkpoint", intake.batch_sink(f"{out}/rows")).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(C("stype_in_symbol").alias("symbol"), F.ltrim("instrument_id", F.lit("0")).alias("instrument_id"), "reason")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS FinInstrmId, p_brand || ', "' || p_type || '"' AS TckrSymb, CAST(p_size AS VARCHAR) AS StrkPric, CAST(NULL AS VARCHAR) AS ISIN FROM part""")
def exchange_files(spark, sf_dir):
    """The exchange's own files, copied as they are and read; columns that they lack are null."""
    path = scratch_dir(spark)
    rows = table(spark, sf_dir, "part").select(C("p_size").alias("StrkPric"), F.concat("p_brand", F.lit(', "'), "p_type", F.lit('"')).alias("TckrSymb"), C("p_partkey").alias("FinInstrmId"), F.lit("x").alias("Other"))
    rows.write.options(header=True, escape='"').csv(f"{path}/raw")
    sinks.copy_files(spark, f"{path}/raw", f"{path}/copy")
    return files.read_exchange_file(spark, f"{path}/copy").select("FinInstrmId", "TckrSymb", "StrkPric", "ISIN")


@query("""
WITH f AS (SELECT p_brand, chr(65279) || string_agg(p_partkey || ',"' || p_type || '"' || chr(13) || chr(10), '' ORDER BY p_partkey) || chr(10) AS v FROM part GROUP BY 1)
SELECT p_brand AS name, strlen(v)::BIGINT AS length, sha256(v) AS sha256 FROM f""")
def copied_files(spark, sf_dir):
    """Files with byte order marks and CRLF copied byte by byte, in folders by name: their lengths and digests as read again."""
    path, line = scratch_dir(spark), F.concat("p_partkey", F.lit(',"'), "p_type", F.lit('"\r\n'))
    rows = table(spark, sf_dir, "part").groupBy(C("p_brand").alias("name")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))).alias("v"))
    rows.select("name", F.concat(F.lit("\ufeff"), F.array_join(F.transform("v", lambda x: x["line"]), ""))).write.partitionBy("name").text(f"{path}/raw")
    sinks.copy_files(spark, f"{path}/raw", f"{path}/copy")
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.txt").load(f"{path}/copy")
    return found.select(F.url_decode(F.regexp_extract("path", "/name=([^/]*)/", 1)).alias("name"), "length", F.sha2("content", 256).alias("sha256"))


@query("""
WITH s AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '.P' || p_partkey WHEN 1 THEN 'P' || p_partkey || '.FUT' WHEN 2 THEN 'P' || p_partkey || '.OPT' WHEN 3 THEN '#P' || p_partkey ELSE 'P' || p_partkey END AS s FROM part)
SELECT 'xcme' AS venue, CASE WHEN p_partkey % 5 < 3 THEN s ELSE s || '.OPT' END AS symbol, 'parent' AS stype_in FROM s UNION ALL SELECT 'xnas', s, 'raw_symbol' FROM s UNION ALL SELECT 'xcme all', 'ALL_SYMBOLS', 'raw_symbol'""")
def venue_symbol_lists(spark, sf_dir):
    """The symbols that two venues are asked for, from one list, and those of a request for all."""
    k, name = C("p_partkey") % 5, F.concat(F.lit("P"), C("p_partkey"))
    line = F.when(k == 0, F.concat(F.lit("."), name)).when(k == 1, F.concat(name, F.lit(".FUT"))).when(k == 2, F.concat(name, F.lit(".OPT"))).when(k == 3, F.concat(F.lit("#"), name)).otherwise(name)
    path = f"{scratch_dir(spark)}/symbols"
    table(spark, sf_dir, "part").select(line).write.text(path)
    parts = [files.venue_symbols(spark, path, v, every).select(F.lit(n).alias("venue"), "symbol", "stype_in") for n, v, every in (("xcme", "xcme", False), ("xnas", "xnas", False), ("xcme all", "xcme", True))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def landed_bars(spark: SparkSession, sf_dir: str) -> str:
    """Minute bars of each kind of event, in folders of underlyings."""
    t = ticks(spark, sf_dir).withColumn("minute", F.date_trunc("minute", "ts"))
    at = F.struct("ts", "event_id")
    rows = t.groupBy(F.upper("event_type").alias("underlying"), C("minute").alias("ts")).agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count("*").alias("volume"))
    path = f"{scratch_dir(spark)}/bars"
    sinks.write_bars(rows, path)
    return path


def landed_underlyings(spark: SparkSession) -> str:
    path = f"{scratch_dir(spark)}/underlyings"
    spark.createDataFrame([("# underlyings",), ("xnas|view",), ("XNAS|click",), ("XABC|purchase",), ("none",)], "value string").coalesce(1).write.text(path)
    return path


_WANTED = "w(exchange, underlying) AS (VALUES ('XNAS', 'VIEW'), ('XNAS', 'CLICK'), ('XABC', 'PURCHASE'), (NULL, 'NONE'))"
_MINUTES = "m AS (SELECT upper(event_type) AS underlying, date_trunc('minute', ts) AS ts, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2)"


@query(f"WITH {_WANTED}, {_MINUTES} SELECT underlying, epoch_us(ts) AS ts, open, high, low, close, volume FROM m WHERE underlying IN (SELECT underlying FROM w) AND ts >= TIMESTAMP '2024-01-10'")
def landed_minute_bars(spark, sf_dir):
    """Landed minute bars of the listed underlyings from a day on."""
    rows = files.read_bars(spark, landed_bars(spark, sf_dir), since="2024-01-10")
    rows = bars.allowed(rows, files.read_underlyings(spark, landed_underlyings(spark)))
    return rows.select("underlying", F.unix_micros("ts").alias("ts"), "open", "high", "low", "close", "volume")


@query(f"""WITH {_WANTED}, {_MINUTES}, d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), c AS (SELECT day AS session_date FROM d WHERE isodow(day) < 6 ORDER BY day DESC LIMIT 3)
SELECT w.underlying, CAST(session_date AS VARCHAR) AS session_date, count(m.ts) AS n_bars, arg_max(m.close, m.ts) AS close FROM w CROSS JOIN c LEFT JOIN m ON m.underlying = w.underlying AND CAST(m.ts AS DATE) = session_date GROUP BY 1, 2""")
def underlyings_by_session(spark, sf_dir):
    """Bars and the last close of every listed underlying in each of the last three sessions, 0 where none landed."""
    days = ticks(spark, sf_dir).select(C("ts").cast("date").alias("session_date")).where(F.weekday("session_date") < 5)
    last = expiry.last_sessions(days, 3, "2030-01-01").select("session_date")
    wanted = bars.sessions_of(files.read_underlyings(spark, landed_underlyings(spark)).select(C("symbol").alias("underlying")), last)
    rows = files.read_bars(spark, landed_bars(spark, sf_dir)).withColumn("session_date", C("ts").cast("date"))
    out = wanted.join(rows, ["underlying", "session_date"], "left").groupBy("underlying", "session_date").agg(F.count("ts").alias("n_bars"), F.max_by("close", "ts").alias("close"))
    return out.withColumn("session_date", C("session_date").cast("string"))


@query("""
WITH l AS (SELECT CASE s_suppkey % 5 WHEN 0 THEN 'XNAS' WHEN 1 THEN 'XCME' WHEN 2 THEN 'X' || s_nationkey WHEN 3 THEN 'XCBO' END AS exchange FROM supplier)
SELECT DISTINCT exchange FROM l WHERE exchange NOT IN ('XCME', 'XCBO', 'XNAS')""")
def unknown_exchanges(spark, sf_dir):
    """Exchanges of a list of all suppliers' symbols that no venue has."""
    k = C("s_suppkey") % 5
    exchange = F.when(k == 0, "xnas|").when(k == 1, "XCME|").when(k == 2, F.concat(F.lit("X"), "s_nationkey", F.lit("|"))).when(k == 3, "xcbo | ").otherwise("")
    path = f"{scratch_dir(spark)}/suppliers"
    table(spark, sf_dir, "supplier").select(F.concat(exchange, F.lit("S"), "s_suppkey")).write.text(path)
    return bars.unknown_exchanges(files.read_underlyings(spark, path), list(VENUES))


_EVENT_MAPS = "m AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, max(value) AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2, 3), n AS (SELECT min(day) AS d FROM m)"


@query(f"""WITH {_EVENT_MAPS}, x AS (SELECT event_type, user_id, day, CASE WHEN day >= d + 10 AND event_type <> 'view' THEN v + 1 ELSE v END AS v FROM m, n WHERE day < d + 20 OR event_type <> 'view')
SELECT event_type, user_id, CAST(day AS VARCHAR) AS day, v FROM x""")
def stored_upserts(spark, sf_dir):
    """A table of maps by day that three batches were merged into, the third the second again; one kind of event is in the first batch only."""
    rows = ticks(spark, sf_dir).where("value IS NOT NULL").groupBy("event_type", "user_id", C("ts").cast("date").alias("day")).agg(F.max("value").alias("v"))
    first = rows.agg(F.min("day").alias("d"))
    rows = rows.join(F.broadcast(first), F.lit(True))  # one row
    maps = lambda df: df.groupBy("event_type", "user_id").agg(F.map_from_entries(F.collect_list(F.struct(C("day").cast("string"), "v"))).alias("data"))
    later = rows.where("day >= date_add(d, 10) AND event_type <> 'view'").withColumn("v", C("v") + 1)
    path = f"{scratch_dir(spark)}/store"
    for batch in (rows.where("day < date_add(d, 20)"), later, later):
        store.upsert(maps(batch), path, "event_type", "user_id")
    return spark.read.parquet(path).select("event_type", "user_id", F.explode("data").alias("day", "v"))


@query("""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE isodow(l_shipdate) < 6 AND l_returnflag = 'R')
SELECT CAST(day AS VARCHAR) AS day, day IN (SELECT day FROM c) AS is_session FROM d""")
def session_days(spark, sf_dir):
    """Whether each day of an order is a session of a calendar of days."""
    calendar = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(C("l_shipdate").cast("date").alias("session_date")).where(F.weekday("session_date") < 5)
    days = table(spark, sf_dir, "orders").select(C("o_orderdate").cast("date").alias("day")).distinct()
    return expiry.mark_sessions(days, calendar).select(C("day").cast("string").alias("day"), "is_session")


_CALENDAR = f"""cal AS (SELECT x::DATE AS day, row_number() OVER (PARTITION BY year(x), month(x), isodow(x) ORDER BY x) AS n, row_number() OVER (PARTITION BY year(x), month(x), isodow(x) ORDER BY x DESC) AS back,
  isodow(x) AS w, month(x) * 100 + day(x) AS md, year(x) AS y FROM generate_series(TIMESTAMP '1980-01-01', TIMESTAMP '2050-12-31', INTERVAL 1 DAY) AS t(x)),
e1 AS (SELECT DISTINCT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM cal), e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2), e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS q FROM e3), good AS (SELECT make_date(y, q // 31, q % 31 + 1) - 2 AS day FROM e4),
hol AS (SELECT day FROM cal WHERE (md // 100 = 1 AND w = 1 AND n = 3 AND y >= 1998) OR (md // 100 = 2 AND w = 1 AND n = 3) OR (md // 100 = 5 AND w = 1 AND back = 1) OR (md // 100 = 9 AND w = 1 AND n = 1) OR (md // 100 = 11 AND w = 4 AND n = 4)
  OR (md = 101 AND w < 6) OR (md = 102 AND w = 1) OR (md IN (704, 1225) AND w < 6) OR (md IN (703, 1224) AND w = 5) OR (md IN (705, 1226) AND w = 1) OR (y >= 2022 AND ((md = 619 AND w < 6) OR (md = 618 AND w = 5) OR (md = 620 AND w = 1)))
  OR day IN ({', '.join(f"DATE '{d}'" for d in calendar.CLOSED)}) UNION SELECT day FROM good),
ses AS (SELECT *, w < 6 AND day NOT IN (SELECT day FROM hol) AS is_session FROM cal)"""


@query(f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders UNION SELECT DISTINCT CAST(ts AS DATE) FROM events UNION SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem), {_CALENDAR}
SELECT CAST(day AS VARCHAR) AS day, is_session, is_session AND (md IN (703, 1224) OR (md // 100 = 11 AND w = 5 AND day - 1 IN (SELECT day FROM cal WHERE md // 100 = 11 AND w = 4 AND n = 4))) AS closes_early FROM d JOIN ses USING (day)""")
def exchange_sessions(spark, sf_dir):
    """The days of all orders, shipments and events: whether the US exchanges trade on them by the calendar's rules, and close early."""
    days = [table(spark, sf_dir, t).select(C(c).cast("date").alias("day")) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    every = days[0].union(days[1]).union(days[2]).distinct()
    return every.select(C("day").cast("string").alias("day"), calendar.is_us_session(C("day")).alias("is_session"), calendar.closes_early(C("day")).alias("closes_early"))


@query(f"""WITH {_CALENDAR}, b AS (SELECT DISTINCT upper(event_type) AS underlying, CAST(ts AS DATE) AS day FROM events WHERE (day(ts) + length(event_type)) % 3 > 0),
r AS (SELECT max(CAST(ts AS DATE)) AS until FROM events), c AS (SELECT day FROM ses, r WHERE is_session AND day <= until ORDER BY day DESC LIMIT 10), u AS (SELECT DISTINCT upper(event_type) AS underlying FROM events UNION SELECT 'P' || p_partkey FROM part WHERE p_size = 1)
SELECT u.underlying, CAST(c.day AS VARCHAR) AS session FROM u, c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.underlying = u.underlying AND b.day = c.day)""")
def missing_bars(spark, sf_dir):
    """Which of the last ten sessions have not landed for which underlying, by the names of folders alone; a kind of event lands on two days of three."""
    t = ticks(spark, sf_dir)
    path = f"{scratch_dir(spark)}/bars"
    some = t.where("(day(ts) + length(event_type)) % 3 > 0").groupBy(F.upper("event_type").alias("underlying"), C("ts").cast("date").alias("session")).agg(F.count("*").alias("volume"))
    some.write.partitionBy("underlying", "session").parquet(path)
    until = t.agg(F.max(C("ts").cast("date")).alias("until"))  # one row
    days = until.select(F.explode(F.sequence(F.date_sub("until", 30), "until")).alias("session_date")).where(calendar.is_us_session(C("session_date")))
    last = expiry.last_sessions(days, 10, "2100-01-01").select(C("session_date").cast("string").alias("session"))
    names = t.select(F.upper("event_type").alias("underlying")).union(table(spark, sf_dir, "part").where("p_size = 1").select(F.concat(F.lit("P"), "p_partkey"))).distinct()
    return bars.sessions_of(names, last).join(files.landed_partitions(spark, path, ["underlying", "session"]), ["underlying", "session"], "left_anti")


_HOURS = "h AS (SELECT upper(event_type) AS underlying, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour, user_id, value, event_id FROM events WHERE value IS NOT NULL)"


@query(f"""WITH {_HOURS}, k AS (SELECT underlying, ((12 - isodow(day)) % 7)::INT AS dte, day, hour, 'K, ' || user_id % 7 AS name, max(value) AS value FROM h WHERE user_id % 3 = 0 GROUP BY ALL)
SELECT underlying, dte, CAST(day AS VARCHAR) AS trade_date, epoch_us(hour) AS ts, name, value FROM k
UNION ALL SELECT underlying, ((12 - isodow(day)) % 7)::INT, CAST(day AS VARCHAR), epoch_us(hour), 'underlying_ltp', arg_max(value, event_id) FROM h GROUP BY 1, 2, 3, 4""")
def matrix_files(spark, sf_dir):
    """Matrices of hours by symbol, a file for each underlying and day with columns of its own, written and read back."""
    t = ticks(spark, sf_dir).where("value IS NOT NULL")
    key = [F.upper("event_type").alias("underlying"), C("ts").cast("date").alias("day"), F.date_trunc("hour", "ts").alias("hour")]
    dte = expiry.days_to_friday(C("day")).cast("int").alias("dte")
    index = t.groupBy(*key).agg(F.max_by("value", "event_id").alias("underlying_ltp"))
    prices = t.where("user_id % 3 = 0").groupBy(*key, F.concat(F.lit("K, "), C("user_id") % 7).alias("symbol")).agg(F.max("value").alias("mid"))
    minutes = index.select("underlying", dte, "day", C("hour").alias("ts"), "underlying_ltp", F.lit(None).cast("double").alias("straddle_3atm"), F.lit(None).cast("double").alias("vt_3atm"))
    path = f"{scratch_dir(spark)}/matrices"
    sinks.write_matrices(minutes, prices.select("underlying", dte, "day", C("hour").alias("ts"), "symbol", "mid"), path)
    cells = files.read_matrix_cells(spark, f"{path}/*/*.csv")
    return cells.select("underlying", "dte", C("trade_date").cast("string").alias("trade_date"), F.unix_micros("ts").alias("ts"), "name", "value")


def _strike():
    return ((C("user_id") % 20) * 25).cast("double")


def _expiry():
    return F.date_add(C("ts").cast("date"), expiry.days_to_friday(C("ts").cast("date")))


def _symbol(strike, side, day):
    return F.concat(F.rpad(F.lit("EVT"), 6, " "), F.date_format(day, "yyMMdd"), side, F.lpad((strike * 1000).cast("long").cast("string"), 8, "0"))


def landed_definitions(spark: SparkSession, sf_dir: str) -> str:
    """Option definitions: for each strike a call and, but for strikes of which no user clicked, a put; all of each Friday."""
    t = ticks(spark, sf_dir)
    kinds = {"purchase": "C", "view": "C", "click": "P"}
    side = F.coalesce(*[F.when(C("event_type") == k, v) for k, v in kinds.items()])
    rows = t.select(_strike().alias("strike_price"), side.alias("side"), _expiry().alias("day"), "user_id").where("side IS NOT NULL AND NOT (side = 'P' AND strike_price IN (75, 250, 425))").distinct()
    path = f"{scratch_dir(spark)}/definitions"
    rows.select(_symbol(C("strike_price"), C("side"), C("day")).alias("raw_symbol"), "strike_price", C("day").cast("timestamp").alias("expiration")).distinct().write.parquet(path)
    return path


def option_minutes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index of hours with the underlying's last value, definitions around the money, prices of pairs on that index)."""
    t = ticks(spark, sf_dir).withColumn("expiry", _expiry())
    index = kept(bars.resample_last(t.where("event_type = 'view'"), ["expiry"], "value", unit="hour", ties=("event_id",)).select("expiry", C("bucket").alias("ts"), C("value").alias("ltp")))
    spot = bars.last_value(index, ["expiry"], "ltp")
    defs = files.read_definitions(spark, landed_definitions(spark, sf_dir)).withColumn("expiry", C("expiration").cast("date"))
    window = bars.ladder(defs, ["expiry"]).join(spot, "expiry").select("expiry", bars.strike_window(C("strikes"), C("ltp"), 6).alias("strikes"))
    defs = kept(bars.at_strikes(defs, window, ["expiry"]))
    quoted = t.where("event_type IN ('purchase', 'click')").withColumn("raw_symbol", _symbol(_strike(), F.when(C("event_type") == "purchase", "C").otherwise("P"), C("expiry")))
    series = bars.fill_forward(bars.resample_last(quoted, ["expiry", "raw_symbol"], "value", unit="hour", ties=("event_id",)), ["expiry", "raw_symbol"], "value", "hour")
    named = series.select("expiry", C("bucket").alias("ts"), "raw_symbol", C("value").alias("mid")).join(defs.select("expiry", "raw_symbol", "strike", "side"), ["expiry", "raw_symbol"])
    prices = bars.on_index(index, named, ["expiry", "ts"]).where("strike IS NOT NULL")
    return index, defs, kept(bars.paired(prices, ["expiry", "ts"], order="raw_symbol"))


_OPTIONS = """e AS (SELECT *, CAST(ts AS DATE) + CAST((12 - isodow(ts)) % 7 AS INT) AS expiry, CAST((user_id % 20) * 25 AS DOUBLE) AS strike FROM events),
idx AS (SELECT expiry, date_trunc('hour', ts) AS ts, arg_max(value, (ts, event_id)) AS ltp FROM e WHERE event_type = 'view' AND value IS NOT NULL GROUP BY 1, 2),
spot AS (SELECT expiry, arg_max(ltp, ts) AS ltp FROM idx GROUP BY 1),
def0 AS (SELECT DISTINCT expiry, strike, CASE event_type WHEN 'click' THEN 'P' ELSE 'C' END AS side FROM e WHERE event_type IN ('purchase', 'view') OR (event_type = 'click' AND strike NOT IN (75, 250, 425))),
lad AS (SELECT expiry, strike, row_number() OVER (PARTITION BY expiry ORDER BY strike) AS i FROM (SELECT DISTINCT expiry, strike FROM def0)),
atm AS (SELECT expiry, arg_min(i, (abs(strike - ltp), i)) AS a FROM lad JOIN spot USING (expiry) GROUP BY 1),
def AS (SELECT def0.* FROM def0 JOIN lad USING (expiry, strike) JOIN atm USING (expiry) WHERE i BETWEEN a - 6 AND a + 6),
q AS (SELECT expiry, strike, CASE event_type WHEN 'click' THEN 'P' ELSE 'C' END AS side, date_trunc('hour', ts) AS ts, arg_max(value, (ts, event_id)) AS v FROM e WHERE event_type IN ('purchase', 'click') AND value IS NOT NULL GROUP BY 1, 2, 3, 4),
p AS (SELECT expiry, ts, strike, max(v) FILTER (side = 'C') AS call, max(v) FILTER (side = 'P') AS put FROM (
  SELECT idx.expiry, idx.ts, def.strike, def.side, q.v, q.ts AS seen, max(q.ts) OVER (PARTITION BY idx.expiry, idx.ts, def.strike, def.side) AS latest, (SELECT max(ts) FROM q z WHERE z.expiry = idx.expiry AND z.strike = def.strike AND z.side = def.side) AS ends
  FROM idx JOIN def USING (expiry) JOIN q ON q.expiry = idx.expiry AND q.strike = def.strike AND q.side = def.side AND q.ts <= idx.ts) WHERE seen = latest AND ts <= ends GROUP BY 1, 2, 3)"""


@query(f"WITH {_OPTIONS} SELECT CAST(expiry AS VARCHAR) AS expiry, epoch_us(ts) AS ts, strike, call, put FROM p WHERE call IS NOT NULL OR put IS NOT NULL")
def option_pairs(spark, sf_dir):
    """Call and put prices, filled forward, of the strikes around the money at each hour of the underlying."""
    return option_minutes(spark, sf_dir)[2].select(C("expiry").cast("string").alias("expiry"), F.unix_micros("ts").alias("ts"), "strike", "call", "put")


@query(f"""
WITH {_OPTIONS}, pairs AS (SELECT expiry, strike FROM def GROUP BY 1, 2 HAVING count(DISTINCT side) = 2),
n AS (SELECT expiry, ts, ltp, strike, row_number() OVER (PARTITION BY expiry, ts ORDER BY abs(strike - ltp), strike) AS n FROM idx JOIN pairs USING (expiry)),
s AS (SELECT n.expiry, n.ts, sum(2 * least(call, put)) AS v FROM n JOIN p USING (expiry, ts, strike) WHERE n <= 3 AND call IS NOT NULL AND put IS NOT NULL GROUP BY 1, 2),
x AS (SELECT idx.expiry, idx.ts, idx.ltp, CASE WHEN ltp > 0 THEN v * 10000 / ltp END AS straddle FROM idx LEFT JOIN s USING (expiry, ts))
SELECT CAST(expiry AS VARCHAR) AS expiry, epoch_us(ts) AS ts, round(straddle, 6) AS straddle, round(straddle * 100 / sqrt(greatest((epoch_us(CAST(expiry AS TIMESTAMP)) + 21 * 3600000000 - epoch_us(ts)) / 6e7, 1)), 6) AS vt FROM x""")
def straddle_vt(spark, sf_dir):
    """Straddle at the money and its ratio to the time left at each hour: the three nearest strikes are chosen by their definitions, then priced."""
    index, defs, pairs = option_minutes(spark, sf_dir)
    out = bars.straddle(bars.both_sides(defs, ["expiry"]), pairs, index, ["expiry"])
    return out.select(C("expiry").cast("string").alias("expiry"), F.unix_micros("ts").alias("ts"), F.round("straddle", 6).alias("straddle"), F.round("vt", 6).alias("vt"))


_SIDES = [f"{k}{s}" for k in (100, 200, 300, 400) for s in "CP"]


@query(f"""WITH {_OPTIONS}, u AS (SELECT expiry, ts, CAST(strike AS INT) || 'C' AS s, call AS v FROM p UNION ALL SELECT expiry, ts, CAST(strike AS INT) || 'P', put FROM p)
SELECT epoch_us(ts) AS ts, {', '.join(f"max(v) FILTER (s = '{s}') AS c{s}" for s in _SIDES)} FROM u WHERE v IS NOT NULL GROUP BY 1""")
def option_matrix(spark, sf_dir):
    """A column for each of some symbols at each hour."""
    pairs = option_minutes(spark, sf_dir)[2]
    sides = [pairs.select("ts", F.concat(C("strike").cast("int").cast("string"), F.lit(s)).alias("symbol"), C(c).alias("mid")) for s, c in (("C", "call"), ("P", "put"))]
    return bars.matrix(sides[0].union(sides[1]).where("mid IS NOT NULL"), _SIDES).select(F.unix_micros("ts").alias("ts"), *[C(s).alias(f"c{s}") for s in _SIDES])

