"""Expirations in nanoseconds, days and minutes to them, and the calendar of sessions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbers import to_double

NS = 1_000_000_000


def expiration_ns(raw: Column, dates_as_text: bool = False) -> Column:
    """Seconds, milliseconds or nanoseconds by their size, as nanoseconds; 0 for none. dates_as_text: eight digits are a date, not seconds."""
    s = F.trim(F.coalesce(raw.cast("string"), F.lit("")))
    n = F.when(s != "", F.coalesce(s.try_cast("long"), to_double(s).try_cast("long")))  # whole numbers without a detour over doubles
    ns = F.when(n > 0, F.try_multiply(n, F.when(n < 10**12, F.lit(NS)).when(n < 10**15, F.lit(1_000_000)).otherwise(F.lit(1)))).otherwise(F.lit(0).cast("long"))
    if dates_as_text:
        day = F.try_to_date(s, "yyyyMMdd")
        ns = F.when(s.rlike(r"^\d{8}$") & day.isNotNull(), F.unix_date(day).cast("long") * 86_400 * NS).otherwise(ns)
    return ns


def day_start_ns(day: str) -> int:
    """Nanoseconds of 00:00 UTC of a day given as YYYYMMDD or YYYY-MM-DD."""
    from datetime import datetime, timezone

    d = datetime.strptime(day.replace("-", ""), "%Y%m%d").replace(tzinfo=timezone.utc)
    return int(d.timestamp()) * NS


def days_to_friday(day: Column) -> Column:
    """Days to Friday; six on Saturday and five on Sunday."""
    return F.pmod(F.lit(4) - F.weekday(day), F.lit(7))


def minutes_to_expiry(expiry: Column, ts: Column, close_hour: int = 21) -> Column:
    """Minutes from ts to close_hour UTC on the expiry's day, one at least."""
    close = F.unix_seconds(expiry.cast("timestamp")) * 1_000_000 + close_hour * 3_600_000_000
    return F.greatest((close - F.unix_micros(ts)) / F.lit(6e7), F.lit(1.0))


def week_expiry(days: DataFrame, calendar: DataFrame, day: str = "day") -> DataFrame:
    """days with target_expiry: the last session from Monday to Friday of the day's week, null if there is none. calendar(session_date)."""
    monday = lambda d: F.date_sub(d, F.weekday(d))
    last = calendar.where(F.weekday("session_date") < 5).groupBy(monday(F.col("session_date")).alias("_week")).agg(F.max("session_date").alias("target_expiry"))
    return days.withColumn("_week", monday(F.col(day))).join(last, "_week", "left").drop("_week")


def last_sessions(calendar: DataFrame, n: int, until: str, inclusive: bool = True) -> DataFrame:
    """The last n sessions up to a day, or before it; position 1 is the newest. The calendar is a small dimension."""
    d = F.lit(until).cast("date")
    upto = calendar.where((F.col("session_date") <= d) if inclusive else (F.col("session_date") < d)).select("session_date").distinct()
    return upto.orderBy(F.desc("session_date")).limit(n).withColumn("position", F.row_number().over(Window.orderBy(F.desc("session_date"))))


def latest_session(calendar: DataFrame, day: str, look_back: int = 30) -> DataFrame:
    """One row: the latest session on a day or up to look_back days before it, null if there is none."""
    d = F.lit(day).cast("date")
    return calendar.where((F.col("session_date") <= d) & (F.col("session_date") >= F.date_sub(d, look_back))).agg(F.max("session_date").alias("session_date"))


def mark_sessions(days: DataFrame, calendar: DataFrame, day: str = "day") -> DataFrame:
    """days with is_session: whether the calendar has the day."""
    known = calendar.select(F.col("session_date").alias(day)).distinct().withColumn("is_session", F.lit(True))
    return days.join(known, day, "left").withColumn("is_session", F.coalesce("is_session", F.lit(False)))


def weekdays(spark, first: str, last: str) -> DataFrame:
    """A calendar of all weekdays, where no list of sessions is given."""
    days = spark.sql(f"SELECT explode(sequence(date '{first}', date '{last}')) AS session_date")
    return days.where(F.weekday("session_date") < 5)


def history_range(as_of: str, look_back: int, first: str, last: str, explicit: str | None = None) -> tuple:
    """(start, end exclusive) of a request, inside what is available; explicit is start and end as sixteen digits."""
    from datetime import datetime, timedelta

    day = lambda s: datetime.strptime(s.replace("-", ""), "%Y%m%d").date()
    if explicit and (len(explicit) != 16 or not explicit.isdigit()):
        raise ValueError("a range is YYYYMMDDYYYYMMDD")
    end = min(day(explicit[8:] if explicit else as_of), day(last)) + timedelta(days=1)
    start = day(explicit[:8]) if explicit else end - timedelta(days=look_back)
    return max(start, day(first)).isoformat(), end.isoformat()


def end_day(token: str, today: str, sessions: list) -> str:
    """`*`: the last session before today; YYYYMMDD: the last one on or before that day; sessions as YYYY-MM-DD."""
    iso = lambda s: f"{s[:4]}-{s[4:6]}-{s[6:]}"
    if token == "*":
        fit = [s for s in sessions if s < today]
    elif len(token) == 8 and token.isdigit():
        fit = [s for s in sessions if s <= iso(token)]
    else:
        raise ValueError("an end is * or YYYYMMDD")
    if not fit:
        raise ValueError("no session up to that day")
    return max(fit)
