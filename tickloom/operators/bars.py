"""Minute bars: last values of buckets, filled forward, strike windows, and straddles at the money."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expiry import minutes_to_expiry


def moment(df: DataFrame, ts: str, ties: tuple = ()) -> Column:
    """An order of rows by time, then by ties. Where the ties are one whole number or none it is a number itself, so that hash aggregates can hold it."""
    kinds = dict(df.dtypes)
    if kinds[ts] in ("timestamp", "timestamp_ntz") and len(ties) <= 1 and all(kinds.get(t) in ("int", "bigint") for t in ties):
        micros = F.unix_micros(F.col(ts).cast("timestamp"))
        return micros.cast("decimal(38,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)") + F.col(ties[0]).cast("decimal(38,0)") if ties else micros
    return F.struct(ts, *ties)


def resample_last(ticks: DataFrame, keys: list, value: str, ts: str = "ts", unit: str = "minute", ties: tuple = ()) -> DataFrame:
    """(keys, bucket, value): the last value that is not null in each bucket of time."""
    some = ticks.where(F.col(value).isNotNull())
    return some.groupBy(*keys, F.date_trunc(unit, ts).alias("bucket")).agg(F.max_by(value, moment(ticks, ts, ties)).alias(value))


def fill_forward(buckets: DataFrame, keys: list, value: str, unit: str = "minute") -> DataFrame:
    """Every bucket from a key's first to its last with the latest value. Each bucket spreads up to the next, so no grid is joined."""
    step = F.expr(f"interval 1 {unit}")
    after = F.lead("bucket").over(Window.partitionBy(*keys).orderBy("bucket"))
    spread = buckets.withColumn("_to", F.coalesce(after - step, F.col("bucket")))
    return spread.select(*keys, F.explode(F.sequence("bucket", "_to", step)).alias("bucket"), value)


def on_index(index: DataFrame, series: DataFrame, on: list) -> DataFrame:
    """Every row of the index with the series' values at its time, or nulls; on: the time and what else both have."""
    return index.join(series, on, "left")


def sessions_of(underlyings: DataFrame, days: DataFrame) -> DataFrame:
    """Every underlying with every session: two short lists, of which one goes to all tasks."""
    return underlyings.crossJoin(F.broadcast(days))  # a list of days that was asked for


def allowed(rows: DataFrame, names: DataFrame, key: str = "underlying") -> DataFrame:
    """Rows of the names in a list."""
    return rows.join(names.select(F.upper("symbol").alias("_name")), F.upper(F.col(key)) == F.col("_name"), "left_semi")


def unknown_exchanges(underlyings: DataFrame, known: list) -> DataFrame:
    """(exchange): the exchanges of a list that are not known."""
    return underlyings.select("exchange").where(F.col("exchange").isNotNull() & ~F.col("exchange").isin(known)).distinct()


def last_value(bars: DataFrame, keys: list, value: str, ts: str = "ts", ties: tuple = ()) -> DataFrame:
    return bars.groupBy(*keys).agg(F.max_by(value, moment(bars, ts, ties)).alias(value))


def ladder(rows: DataFrame, keys: list, strike: str = "strike") -> DataFrame:
    """(keys, strikes): the sorted distinct strikes, of which there are a few hundred at most."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(strike)).alias("strikes"))


def strike_window(strikes: Column, spot: Column, around: int = 10) -> Column:
    """The strikes up to `around` places from the one nearest to spot, the lower of two equally near."""
    near = F.array_min(F.transform(strikes, lambda k, i: F.struct(F.abs(k - spot).alias("d"), i.alias("i"))))["i"]
    first = F.greatest(near - around, F.lit(0))
    return F.slice(strikes, first + 1, near + around - first + 1)


def at_strikes(rows: DataFrame, strikes: DataFrame, keys: list) -> DataFrame:
    """Rows whose strike is among those wanted(keys, strikes)."""
    return rows.join(strikes.select(*keys, F.explode("strikes").alias("strike")), [*keys, "strike"], "left_semi")


def nearest_strikes(strikes: Column, ltp: Column, n: int = 3) -> Column:
    """The n strikes nearest to ltp, nearest first; lower strikes first where two are equally near."""
    return F.transform(F.slice(F.array_sort(F.transform(strikes, lambda k: F.struct(F.abs(k - ltp).alias("d"), k.alias("k")))), 1, n), lambda x: x["k"])


def paired(quotes: DataFrame, keys: list, price: str = "mid", side: str = "side", order: str = "symbol") -> DataFrame:
    """(keys, strike, call, put): the first symbol's price of each side, null where a side is missing."""
    first = lambda s: F.min_by(F.when(F.col(side) == s, F.col(price)), F.when(F.col(side) == s, F.col(order)))
    return quotes.groupBy(*keys, "strike").agg(first("C").alias("call"), first("P").alias("put"))


def both_sides(definitions: DataFrame, keys: list) -> DataFrame:
    """(keys, strikes): the sorted strikes that are defined as a call and as a put."""
    sides = definitions.groupBy(*keys, "strike").agg(F.max(F.col("side") == "C").alias("_c"), F.max(F.col("side") == "P").alias("_p"))
    return ladder(sides.where("_c AND _p"), keys)


def straddle(strikes: DataFrame, prices: DataFrame, minutes: DataFrame, keys: list, n: int = 3) -> DataFrame:
    """(minutes' columns, straddle, vt) over the n strikes nearest to ltp of those defined on both sides.

    strikes(keys, strikes) as of both_sides; prices(keys, ts, strike, call, put); minutes has the keys, ts, ltp and expiry. Of the chosen
    strikes, those without both prices at that minute are left out: straddle = sum of twice the lesser price, times 10000 / ltp; vt = 100 *
    straddle / root of the minutes to expiry. Both are null where none is left, or ltp is not positive.
    """
    own = prices.where(F.col("call").isNotNull() & F.col("put").isNotNull()).groupBy(*keys, "ts")
    own = own.agg(F.map_from_entries(F.collect_list(F.struct(F.col("strike"), (2 * F.least("call", "put")).alias("p")))).alias("_prices"))
    joined = minutes.join(strikes, keys, "left").join(own, [*keys, "ts"], "left")
    some = F.filter(F.transform(nearest_strikes(F.col("strikes"), F.col("ltp"), n), lambda k: F.try_element_at("_prices", k)), lambda x: x.isNotNull())
    total = F.aggregate("_some", F.lit(0.0), lambda s, x: s + x)
    joined = joined.withColumn("_some", some).withColumn("straddle", F.when((F.size("_some") > 0) & (F.col("ltp") > 0), total * 10_000 / F.col("ltp"))).drop("_some", "_prices", "strikes")
    return joined.withColumn("vt", F.col("straddle") * 100 / F.sqrt(minutes_to_expiry(F.col("expiry"), F.col("ts"))))


def matrix(rows: DataFrame, symbols: list, index: str = "ts", value: str = "mid") -> DataFrame:
    """A column for each of the given symbols; the list is given so that no job has to find it."""
    return rows.groupBy(index).pivot("symbol", symbols).agg(F.first(value, ignorenulls=True))


def time_of_day(ts: Column, trade_date: Column, shift_from: str | None = None) -> Column:
    """The time of day on 1970-01-01, an hour later from a date on."""
    t = F.timestamp_micros(F.pmod(F.unix_micros(ts), F.lit(86_400_000_000)))
    return F.when(trade_date >= F.lit(shift_from).cast("date"), t + F.expr("interval 60 minutes")).otherwise(t) if shift_from else t


def time_of_day_store(rows: DataFrame, key: str, date: str, value: str, order: list) -> DataFrame:
    """(key, data): for each time of day a map from date to the first value in order, null for NaN; rows without a key go."""
    clean = F.when(~F.isnan(value), F.col(value))
    firsts = rows.where(F.col(key).isNotNull()).groupBy(key, date).agg(F.min_by(F.struct(clean.alias("v")), F.struct(*order)).alias("f"))
    return firsts.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(date), F.col("f.v").alias("v"))))).alias("data"))


def merge_store(old: DataFrame, new: DataFrame, key: str, maps: tuple = ("data",)) -> DataFrame:
    """Old rows with new ones merged in: for each map the new entries win."""
    n = new.select(key, *[F.col(m).alias(f"_{m}") for m in maps])
    merged = [F.expr(f"CASE WHEN {m} IS NULL THEN _{m} WHEN _{m} IS NULL THEN {m} ELSE map_concat(map_filter({m}, (k, v) -> NOT array_contains(map_keys(_{m}), k)), _{m}) END").alias(m) for m in maps]
    return old.join(n, key, "full").select(key, *merged)
