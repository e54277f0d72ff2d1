"""The named queries over the driver's tables, and their DuckDB counterparts.

Contracts are the rows of lineitem: the root is the part, the expiration the day of shipping, the kind the return flag. Bars are events.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, expiry, numbers, sessions, symbols
from ..operators import bars, baskets, contracts, normalize

QUERIES: dict = {}
ORACLES: dict = {}
AS_OF = "1998-01-01"
#: A total order of the contracts.
ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity"]
_ORDER = ", ".join(ORDER)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    from . import daily  # noqa: F401, its queries register themselves

    return dict(QUERIES)


def oracle_sql() -> dict:
    queries()
    return dict(ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_contracts(spark: SparkSession, sf_dir: str, live: str | None = None) -> DataFrame:
    """Contracts of lineitem; with live those that expire on that day or later, by a bound on the stored day that reaches the scan."""
    flag, rows = F.col("l_returnflag"), table(spark, sf_dir, "lineitem")
    rows = rows.where(F.col("l_shipdate") >= F.lit(live).cast("timestamp_ntz")) if live else rows
    return rows.select(
        *ORDER, F.lit("XNSE").alias("exchange"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("script"), F.when(flag == "N", "FUTSTK").otherwise("OPTSTK").alias("scriptInstrumentType"),
        F.when(flag == "R", "CALL").when(flag == "A", "PUT").otherwise("").alias("optionType"), F.col("l_partkey").cast("string").alias("underlying_root"),
        (F.unix_micros(F.col("l_shipdate").cast("timestamp")) * 1000).alias("expiration"), numbers.scale_price(F.col("l_extendedprice")).alias("strike"),
    )


_C = """c AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity, l_orderkey || '-' || l_linenumber AS script, l_returnflag AS kind,
  epoch_us(l_shipdate) * 1000 AS expiration, CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS strike FROM lineitem),
live AS (SELECT * FROM c WHERE expiration >= 883612800000000000)"""
OUT = ["l_partkey", "l_orderkey", "l_linenumber", "expiration", "strike"]
_OUT = ", ".join(OUT)


def _live(spark, sf_dir) -> DataFrame:
    return line_contracts(spark, sf_dir, AS_OF)


def _wanted(spark, sf_dir) -> DataFrame:
    return baskets.roots(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal")), F.col("ordinal").cast("string"))


_NEAR = f"SELECT {_OUT} FROM live WHERE kind = 'N' QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY expiration, {_ORDER}) = 1"
_ALL = f"SELECT {_OUT} FROM live WHERE kind = 'N' AND l_partkey IN (SELECT p_partkey FROM part)"
_CHAIN = f"SELECT {_OUT} FROM live WHERE kind <> 'N' QUALIFY dense_rank() OVER (PARTITION BY l_partkey ORDER BY expiration) <= 2"


@query(f"WITH {_C} {_NEAR}")
def roll_nearest_future(spark, sf_dir):
    """The nearest live future of each root."""
    return baskets.nearest(_live(spark, sf_dir).where(contracts.is_future()), "l_partkey", "expiration", ORDER).select(OUT)


@query(f"WITH {_C} {_ALL}")
def roll_all_futures(spark, sf_dir):
    """All live futures of the roots of a template."""
    return baskets.of_roots(_wanted(spark, sf_dir), _live(spark, sf_dir).where(contracts.is_future()), "underlying_root").select(OUT)


@query(f"WITH {_C} {_CHAIN}")
def roll_option_chain_2(spark, sf_dir):
    """All strikes of the two nearest expirations of each root."""
    return baskets.chain(_live(spark, sf_dir).where(contracts.is_option()), "l_partkey", "expiration", 2).select(OUT)


@query(f"WITH {_C} SELECT 0 AS part, * FROM ({_NEAR}) UNION ALL SELECT 1, * FROM ({_ALL}) UNION ALL SELECT 2, * FROM ({_CHAIN})")
def basket_union(spark, sf_dir):
    """Three rolls, one after another."""
    parts = [f(spark, sf_dir).select(F.lit(i).alias("part"), *OUT) for i, f in enumerate((roll_nearest_future, roll_all_futures, roll_option_chain_2))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _template(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("ordinal"), F.concat_ws("-", "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(99)).alias("script"), "o_orderpriority")


_T = "t AS (SELECT o_orderkey AS ordinal, o_orderkey || '-' || CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 99 END AS script, o_orderpriority FROM orders)"


@query(f"WITH {_C}, {_T}, k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY script ORDER BY {', '.join(x + ' DESC' for x in ORDER)}) = 1) SELECT ordinal, script, {_OUT} FROM t JOIN k USING (script)")
def basket_by_script(spark, sf_dir):
    """The contracts that a template names, the last where one occurs twice."""
    return baskets.last_by_script(_template(spark, sf_dir), line_contracts(spark, sf_dir), ORDER).select("ordinal", "script", *OUT)


@query(f"WITH {_C}, {_T} SELECT ordinal, script FROM t WHERE script NOT IN (SELECT script FROM c)")
def basket_missing(spark, sf_dir):
    """Scripts of a template that no contract has."""
    return baskets.missing_scripts(_template(spark, sf_dir), line_contracts(spark, sf_dir)).select("ordinal", "script")


@query(f"WITH {_C}, {_T} SELECT o_orderpriority, count(*) FILTER (script IN (SELECT script FROM c)) AS found, count(*) FILTER (script NOT IN (SELECT script FROM c)) AS missing FROM t GROUP BY 1")
def coverage_report(spark, sf_dir):
    """Found and missing lines of a template by priority."""
    return baskets.coverage(_template(spark, sf_dir), line_contracts(spark, sf_dir), "script", ["o_orderpriority"])


@query("SELECT p_brand, to_json(list(CAST(p_partkey AS VARCHAR) ORDER BY p_partkey)) AS scripts FROM part GROUP BY 1")
def basket_documents(spark, sf_dir):
    """A JSON array of scripts for each basket."""
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.col("p_partkey").cast("string").alias("script"))
    return baskets.documents(rows, "p_brand", "script", [F.col("p_partkey")])


@query(f"WITH {_C} SELECT {_OUT} FROM c QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) = 1")
def contract_dedup(spark, sf_dir):
    """The first contract of each key."""
    return contracts.unique_contracts(line_contracts(spark, sf_dir), ORDER, ("l_orderkey", "l_linenumber")).select(OUT)


@query(f"WITH {_C}, z AS (SELECT * REPLACE (CASE WHEN l_quantity < 3 THEN 0 ELSE expiration END AS expiration) FROM c) SELECT {_OUT} FROM z WHERE expiration = 0 OR expiration <= 699408000000000000 + 14 * 86400000000000")
def strip_near_term(spark, sf_dir):
    """Contracts without an expiration, or with one within 14 days."""
    rows = line_contracts(spark, sf_dir).withColumn("expiration", F.when(F.col("l_quantity") < 3, 0).otherwise(F.col("expiration")))
    return contracts.near_term(rows, "1992-03-01").select(OUT)


_OCC_ROOTS = ["SPX", "NVDA", "RUT", "spxw", "BRK B"]


@query("""
WITH s AS (SELECT o_orderkey, rpad(['SPX', 'NVDA', 'RUT', 'spxw', 'BRK B'][1 + o_orderkey % 5], 6, ' ') || strftime(o_orderdate + INTERVAL (30 * (o_orderkey % 2)) YEAR, '%y%m%d')
  || CASE WHEN o_orderkey % 3 = 0 THEN 'C' ELSE 'P' END || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 100000000 AS VARCHAR), 8, '0') || CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE '' END AS symbol FROM orders),
p AS (SELECT o_orderkey, symbol, regexp_matches(symbol, '[0-9]{6}[CP][0-9]{8}$') AS ok, upper(replace(regexp_extract(symbol, '^(.*?)([0-9]{6})([CP])([0-9]{8})$', 1), ' ', '')) AS root,
  regexp_extract(symbol, '^(.*?)([0-9]{6})([CP])([0-9]{8})$', 2) AS d, regexp_extract(symbol, '^(.*?)([0-9]{6})([CP])([0-9]{8})$', 3) AS side, regexp_extract(symbol, '^(.*?)([0-9]{6})([CP])([0-9]{8})$', 4) AS k FROM s)
SELECT o_orderkey, CASE WHEN ok THEN root ELSE '' END AS root, CASE side WHEN 'C' THEN 'CALL' WHEN 'P' THEN 'PUT' ELSE '' END AS option_type, CASE WHEN ok THEN CAST(k AS BIGINT) * 1000000 ELSE 0 END AS strike,
  ok AND root IN ('SPX', 'SPXW', 'VIX', 'RUT') AS is_index,
  CASE WHEN ok THEN epoch_us((CAST((CASE WHEN CAST(d[1:2] AS INT) <= 30 THEN '20' ELSE '19' END) || d[1:2] || '-' || d[3:4] || '-' || d[5:6] AS DATE) + CASE WHEN root IN ('SPX', 'SPXW', 'VIX', 'RUT') THEN TIME '17:00:00' ELSE TIME '16:15:00' END) AT TIME ZONE 'America/New_York') * 1000 ELSE 0 END AS expiration
FROM p""")
def parse_occ(spark, sf_dir):
    """Option symbols built from orders, taken apart."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    root = F.rpad(F.element_at(F.array(*[F.lit(r) for r in _OCC_ROOTS]), (1 + key % 5).cast("int")), 6, " ")
    yymmdd = F.date_format(F.when(key % 2 == 1, F.add_months(day, 360).cast("timestamp")).otherwise(day), "yyMMdd")
    strike = F.lpad((F.floor("o_totalprice") % 100_000_000).cast("string"), 8, "0")
    symbol = F.concat(root, yymmdd, F.when(key % 3 == 0, "C").otherwise("P"), strike, F.when(key % 11 == 0, "X").otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", symbols.occ(symbol).alias("x")).select("o_orderkey", "x.*")


@query("""
WITH s AS (SELECT o_orderkey, 'ES' || 'FGHJKMNQUVXZ'[month(o_orderdate)] || o_orderkey % 10 AS base, o_orderkey % 4 AS kind, CAST(floor(o_totalprice) AS BIGINT) AS k FROM orders),
y AS (SELECT *, month(o_orderdate) AS m, 2020 + o_orderkey % 10 + CASE WHEN 2020 + o_orderkey % 10 < 2021 THEN 10 ELSE 0 END AS y FROM s JOIN orders USING (o_orderkey))
SELECT o_orderkey, CASE kind WHEN 0 THEN '' WHEN 1 THEN 'PUT' WHEN 2 THEN 'CALL' ELSE '' END AS option_type, CASE kind WHEN 1 THEN k * 1000000000 WHEN 2 THEN k * 1000000000 + 500000000 ELSE 0 END AS strike,
  CASE WHEN kind = 3 THEN 0 ELSE epoch_us(make_date(y, m, 1)::TIMESTAMP) * 1000 END AS expiration, CASE WHEN kind = 3 THEN 'ES' ELSE regexp_extract(base, '^[A-Z]+') END AS root FROM y""")
def parse_glbx(spark, sf_dir):
    """Symbols with month codes built from orders, taken apart as of 2026."""
    key, k = F.col("o_orderkey"), F.floor("o_totalprice").cast("string")
    base = F.concat(F.lit("ES"), F.substring(F.lit(symbols.MONTH_CODES), F.month(F.col("o_orderdate")), F.lit(1)), (key % 10).cast("string"))
    symbol = F.when(key % 4 == 1, F.concat(base, F.lit(" P"), k)).when(key % 4 == 2, F.concat(base, F.lit(" C"), k, F.lit(".5"))).when(key % 4 == 3, "ES.OPT").otherwise(base)
    return table(spark, sf_dir, "orders").select("o_orderkey", symbols.future_or_option(symbol, F.lit(2026)).alias("x"), symbols.symbol_root(symbol).alias("root")).select("o_orderkey", "x.*", "root")


@query("""
WITH s AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'NSE:' || r || '-EQ' WHEN 1 THEN 'NSE:' || r || '26AUGFUT' WHEN 2 THEN 'MCX:' || r || '26AUG' || p_size || '.25CE' ELSE 'NSE:' || r || '-D1' END AS script
  FROM (SELECT *, replace(replace(p_brand, '#', ''), ' ', '') || 'x50' AS r FROM part))
SELECT p_partkey, upper(regexp_extract(script, '^[^:]+:(.+)-EQ$', 1)) AS eq_root, upper(regexp_extract(script, '^[^:]+:(.+?)[0-9]{2}(?:JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)FUT$', 1)) AS fut_root,
  upper(regexp_extract(script, '^[^:]+:(.+?)[0-9]{2}(?:JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)[0-9]+(?:\\.[0-9]+)?(?:CE|PE)$', 1)) AS opt_root FROM s""".replace("\\\\", "\\"))
def parse_roots(spark, sf_dir):
    """Roots of equity, future and option scripts built from parts."""
    r, k = F.concat(F.regexp_replace("p_brand", "[# ]", ""), F.lit("x50")), F.col("p_partkey")
    script = F.when(k % 4 == 0, F.concat(F.lit("NSE:"), r, F.lit("-EQ"))).when(k % 4 == 1, F.concat(F.lit("NSE:"), r, F.lit("26AUGFUT"))).when(k % 4 == 2, F.concat(F.lit("MCX:"), r, F.lit("26AUG"), F.col("p_size").cast("string"), F.lit(".25CE"))).otherwise(F.concat(F.lit("NSE:"), r, F.lit("-D1")))
    return table(spark, sf_dir, "part").select("p_partkey", *[symbols.script_root(script, kind).alias(f"{kind.lower()}_root") for kind in ("EQ", "FUT", "OPT")])


@query("""
SELECT o_orderkey, CAST(round_even(o_totalprice * 100, 0) AS BIGINT) AS price, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(round_even((o_orderkey % 1000) / 8.0 * 100, 0) AS BIGINT) END AS text_price,
  CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(round_even(greatest((o_orderkey % 1000 - 500) / 8.0, 0) * 100, 0) AS BIGINT) END AS positive, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE CAST(trunc((o_orderkey % 77) / 4.0) AS BIGINT) END AS lots FROM orders""")
def scale_price(spark, sf_dir):
    """Fixed-point prices of numbers and texts, some of them bad."""
    k = F.col("o_orderkey")
    bad = F.when(k % 2 == 0, "invalid").otherwise("1.5d")
    text = F.when(k % 3 == 0, bad).otherwise((k % 1000 / F.lit(8.0)).cast("string"))
    signed = F.when(k % 3 == 0, bad).otherwise(((k % 1000 - 500) / F.lit(8.0)).cast("string"))
    lots = F.when(k % 5 == 0, "").otherwise((k % 77 / F.lit(4.0)).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.scale_price(F.col("o_totalprice")).alias("price"), numbers.scale_price(text).alias("text_price"), numbers.positive_price(signed).alias("positive"), numbers.lot_size(lots).alias("lots"))


_NAMES = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in codes.INSTRUMENTS.items()) + "}"
_MARKETS = "MAP {" + ", ".join(f"'{e}/{k}': '{v}'" for (e, k), v in codes.MARKETS.items()) + "}"


@query(f"""
WITH n AS (SELECT p_partkey, coalesce({_NAMES}[p_size], 'UNKNOWN_' || p_size) AS name, coalesce({_MARKETS}[(10 + p_partkey % 4) || '/' || (10 + p_size % 13)], '') AS market, p_size FROM part)
SELECT p_partkey, name, CASE WHEN name = 'EQ' THEN 'EQUITY' WHEN name LIKE 'FUT%' THEN 'FUTURE' WHEN name LIKE 'OPT%' THEN 'OPTION' ELSE name END AS class, market,
  name LIKE '%FUT%' AS names_future, name IN ('EQ', 'ETF') AS is_cash, ['CALL', 'PUT', ''][1 + p_partkey % 3] AS option_type FROM n""")
def classify_instrument(spark, sf_dir):
    """Names, classes and markets of codes, some of them unknown."""
    name = codes.instrument_name(F.concat(F.lit(" "), F.col("p_size").cast("string")))
    market = codes.market((10 + F.col("p_partkey") % 4).cast("string"), (10 + F.col("p_size") % 13).cast("string"))
    side = codes.call_or_put(F.element_at(F.array(F.lit("ce"), F.lit(" PE"), F.lit("XX")), (1 + F.col("p_partkey") % 3).cast("int")))
    named = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), market.alias("market"), side.alias("option_type"))
    return named.select("p_partkey", "name", codes.instrument_class(F.col("name")).alias("class"), "market", codes.names_future(F.col("name")).alias("names_future"), codes.is_cash(F.col("name")).alias("is_cash"), "option_type")


@query("""
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 5 THEN 0 WHEN 4 THEN 20260730000000000 ELSE (epoch_us(o_orderdate) + 946684800000000) * 1000 END AS expiration, CASE o_orderkey % 6 WHEN 4 THEN 1785369600000000000 WHEN 0 THEN 0 WHEN 5 THEN 0 ELSE (epoch_us(o_orderdate) + 946684800000000) * 1000 END AS as_date FROM orders""")
def expiry_units(spark, sf_dir):
    """Expirations in seconds, milliseconds and nanoseconds, and texts that are none."""
    k, s = F.col("o_orderkey") % 6, F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + 946_684_800
    raw = F.when(k == 0, "-1").when(k == 1, s.cast("string")).when(k == 2, (s * 1000).cast("string")).when(k == 3, (s * 1_000_000_000).cast("string")).when(k == 4, "20260730").otherwise("abc")
    return table(spark, sf_dir, "orders").select("o_orderkey", expiry.expiration_ns(raw).alias("expiration"), expiry.expiration_ns(raw, dates_as_text=True).alias("as_date"))


@query("""
WITH e AS (SELECT event_id, hour(ts) * 60 + minute(ts) AS a, (hour(ts) * 60 + minute(ts) + 375) % 1440 AS z FROM events),
u AS (SELECT event_id, (a + 1110) % 1440 AS a, (z + 1110) % 1440 AS z FROM e)
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '' ELSE CASE WHEN event_id % 2 = 0 THEN '0330-0338|' ELSE '' END || lpad(CAST(a // 60 AS VARCHAR), 2, '0') || lpad(CAST(a % 60 AS VARCHAR), 2, '0') || '-' || lpad(CAST(z // 60 AS VARCHAR), 2, '0') || lpad(CAST(z % 60 AS VARCHAR), 2, '0') || '|1245-1345' END AS session FROM u""")
def ist_session(spark, sf_dir):
    """Indian sessions in UTC, some of them bad, with the auction before the cash market."""
    ts = F.col("ts").cast("timestamp")
    text = F.concat(F.date_format(ts, "HHmm"), F.lit("-"), F.date_format(ts + F.expr("interval 375 minutes"), "HHmm"), F.when(F.col("event_id") % 9 == 0, "|2400-2500").otherwise("|1815-1915:"))
    return table(spark, sf_dir, "events").select("event_id", sessions.with_pre_open(sessions.ist_sessions(text), F.when(F.col("event_id") % 2 == 0, "CM").otherwise("FO")).alias("session"))


def _slot_sql(s: str, e: str) -> str:
    at = lambda t, add: f"strftime(((d + INTERVAL {add} DAY)::DATE + TIME '{t[:2]}:{t[2:]}:00') AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC', '%H%M')"
    return f"{at(s, 0)} || '-' || {at(e, int(e <= s))}"


_US = ", ".join(" || '|' || ".join(_slot_sql(*x) for x in slots) + f" AS {v}" for v, slots in sessions.US_SLOTS.items())


@query(f"WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders) SELECT CAST(d AS VARCHAR) AS day, {_US} FROM d")
def us_sessions(spark, sf_dir):
    """The sessions of the US venues on every day that occurs, among them switches of daylight saving."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d")).union(table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date"))).distinct()
    return days.select(F.col("d").cast("string").alias("day"), *[sessions.us_session(F.col("d"), v).alias(v) for v in sessions.US_SLOTS])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 7 WHEN 3 THEN 'XBOM' WHEN 4 THEN 'XBOM' WHEN 5 THEN 'XIMC' ELSE 'XNSE' END AS exchange, CASE l_linenumber % 7 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS source_ord
FROM lineitem WHERE l_linenumber % 7 < 6""")
def venue_bundle_union(spark, sf_dir):
    """Rows of six markets in three bundles; those of a market in none go."""
    market = F.element_at(F.array(*[F.lit(m) for m in ("XNSE", "XNFO", "XNCD", "XBSE", "XBFO", "XMCX", "XNCO")]), (1 + F.col("l_linenumber") % 7).cast("int"))
    return normalize.bundle(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", market.alias("market"))).select("l_orderkey", "l_linenumber", "l_partkey", "exchange", "source_ord")


def ticks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


_HOUR = "h AS (SELECT user_id, date_trunc('hour', ts) AS bucket, arg_max(value, (ts, event_id)) AS value FROM events WHERE value IS NOT NULL GROUP BY 1, 2)"


@query(f"WITH {_HOUR} SELECT user_id, epoch_us(bucket) AS bucket, value FROM h")
def resample_last(spark, sf_dir):
    """The last value of each user and hour."""
    out = bars.resample_last(ticks(spark, sf_dir), ["user_id"], "value", unit="hour", ties=("event_id",))
    return out.select("user_id", F.unix_micros("bucket").alias("bucket"), "value")


@query(f"""
WITH {_HOUR}, g AS (SELECT user_id, unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS bucket FROM h GROUP BY 1)
SELECT user_id, epoch_us(bucket) AS bucket, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS value FROM g LEFT JOIN h USING (user_id, bucket)""")
def resample_ffill(spark, sf_dir):
    """Every hour of each user with the latest value."""
    out = bars.fill_forward(bars.resample_last(ticks(spark, sf_dir), ["user_id"], "value", unit="hour", ties=("event_id",)), ["user_id"], "value", "hour")
    return out.select("user_id", F.unix_micros("bucket").alias("bucket"), "value")


def _spots(spark, sf_dir) -> DataFrame:
    return bars.last_value(ticks(spark, sf_dir).withColumn("day", F.col("ts").cast("date")), ["user_id", "day"], "value", ties=("event_id",))


_SPOT = "spot AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2)"


@query(f"WITH {_SPOT} SELECT user_id, CAST(day AS VARCHAR) AS day, value FROM spot")
def spot_last(spark, sf_dir):
    """The last value of each user and day."""
    return _spots(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), "value")


def _ladder():
    return F.sequence(F.lit(10), F.lit(500), F.lit(10))


@query(f"""
WITH {_SPOT}, k AS (SELECT k, (k // 10) - 1 AS i FROM range(10, 501, 10) AS t(k)), m AS (SELECT user_id, day, arg_min(i, (abs(k - value), k)) AS atm FROM spot, k GROUP BY 1, 2)
SELECT user_id, CAST(day AS VARCHAR) AS day, CAST(k AS INT) AS strike FROM m JOIN k ON i BETWEEN atm - 3 AND atm + 3""")
def strike_window(spark, sf_dir):
    """Three strikes on each side of the one at the money, for each user and day."""
    return _spots(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), F.explode(bars.strike_window(_ladder(), F.col("value"), 3)).alias("strike"))


@query("""
WITH k AS (SELECT event_id, k, row_number() OVER (PARTITION BY event_id ORDER BY abs(k - value), k) AS n FROM events, range(10, 501, 10) AS t(k))
SELECT event_id, CAST(n AS INT) AS n, CAST(k AS INT) AS strike FROM k WHERE n <= 3""")
def nearest3(spark, sf_dir):
    """The three strikes nearest to each value."""
    rows = ticks(spark, sf_dir).select("event_id", F.posexplode(bars.nearest_strikes(_ladder(), F.col("value"))).alias("n", "strike"))
    return rows.select("event_id", (F.col("n") + 1).alias("n"), "strike")


@query("""
WITH c AS (SELECT CAST(d AS DATE) AS d FROM range(DATE '2023-12-25', DATE '2024-02-10', INTERVAL 1 DAY) AS t(d) WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN (DATE '2024-01-19', DATE '2024-01-26', DATE '2024-01-25')),
x AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
SELECT CAST(day AS VARCHAR) AS day, CAST((12 - isodow(day)) % 7 AS INT) AS dte, CAST((SELECT max(d) FROM c WHERE date_trunc('week', d) = date_trunc('week', day)) AS VARCHAR) AS target_expiry FROM x""")
def dte_expiry(spark, sf_dir):
    """Days to Friday, and the last session of the week under a calendar with holidays."""
    calendar = expiry.weekdays(spark, "2023-12-25", "2024-02-09").where(~F.col("session_date").cast("string").isin("2024-01-19", "2024-01-26", "2024-01-25"))
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day")).distinct()
    return expiry.week_expiry(days, calendar).select(F.col("day").cast("string").alias("day"), expiry.days_to_friday(F.col("day")).alias("dte"), F.col("target_expiry").cast("string").alias("target_expiry"))


@query("""
WITH c AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE isodow(ts) < 6 AND CAST(ts AS DATE) <= DATE '2024-01-25')
SELECT CAST(d AS VARCHAR) AS session_date, CAST(row_number() OVER (ORDER BY d DESC) AS INT) AS position FROM c QUALIFY position <= 5""")
def sessions_last_n(spark, sf_dir):
    """The last five sessions up to a day."""
    calendar = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("session_date")).where(F.weekday("session_date") < 5)
    return expiry.last_sessions(calendar, 5, "2024-01-25").select(F.col("session_date").cast("string").alias("session_date"), "position")


@query("""
SELECT hour(ts) * 60 + minute(ts) + CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN 60 ELSE 0 END AS minute, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2""")
def time_of_day_store(spark, sf_dir):
    """For each minute of the day a map from date to its first value, an hour later from a date on; as rows."""
    t = ticks(spark, sf_dir).withColumn("date", F.col("ts").cast("date"))
    minute = F.floor(F.unix_micros(bars.time_of_day(F.col("ts"), F.col("date"), "2024-01-15")) / 60_000_000).cast("long")
    store = bars.time_of_day_store(t.select(minute.alias("minute"), F.col("date").cast("string").alias("date"), "value", "ts", "event_id"), "minute", "date", "value", ["ts", "event_id"])
    return store.select("minute", F.explode("data").alias("date", "value"))


@query("""
WITH e AS (SELECT user_id, event_type AS date, CASE user_id % 5 WHEN 3 THEN 0 WHEN 4 THEN 1 ELSE event_id % 2 END AS part, arg_min(value, (ts, event_id)) AS v FROM events GROUP BY 1, 2, 3)
SELECT user_id, date, coalesce(max(v) FILTER (part = 1), max(v) FILTER (part = 0)) AS value FROM e GROUP BY 1, 2""")
def upsert_merge(spark, sf_dir):
    """Two stores merged, the new entries winning, some users in one of them only; as rows."""
    t = ticks(spark, sf_dir).withColumn("part", F.expr("CASE user_id % 5 WHEN 3 THEN 0 WHEN 4 THEN 1 ELSE event_id % 2 END"))
    half = lambda i: bars.time_of_day_store(t.where(F.col("part") == i), "user_id", "event_type", "value", ["ts", "event_id"])
    return bars.merge_store(half(0), half(1), "user_id").select("user_id", F.explode("data").alias("date", "value"))
