"""Trading sessions as UTC text: fixed-offset Indian slots, and US slots that follow daylight saving."""

from pyspark.sql import Column
from pyspark.sql import functions as F

IST_MINUTES = 330
PRE_OPEN = "0330-0338"
EASTERN = "America/New_York"
#: Fixed values: (start, end) of the slots before, in and after the main session, in Eastern time.
US_SLOTS = {
    "xnas": (("0400", "0930"), ("0930", "1600"), ("1600", "2000")),
    "xcbo_equity": (("0730", "0925"), ("0930", "1600"), ("1600", "1615")),
    "xcbo_index": (("2015", "0925"), ("0930", "1615"), ("1615", "1700")),
    "xcme": (("1800", "0930"), ("0930", "1615"), ("1615", "1700")),
}


def _once(value: Column, use) -> Column:
    """use(value) with the value computed once, where expressions within lambdas are interpreted and would compute it for each mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Slots as the feed writes them, and how many of these are converted without lambdas.
_SLOT, SLOTS = r"([01]\d|2[0-3])[0-5]\d-([01]\d|2[0-3])[0-5]\d", 3


def _minutes(hhmm: Column) -> Column:
    """Minutes of a text of hours and minutes, null if it is no time of day. One digit of either will do."""
    h, m = F.substring(hhmm, 1, 2), F.substring(hhmm, 3, 1 << 20)
    number = r"^\s*\+?\d{1,9}\s*$"
    ok = h.rlike(number) & m.rlike(number)
    hour, minute = F.trim(h).try_cast("int"), F.trim(m).try_cast("int")
    return F.when(ok & hour.between(0, 23) & minute.between(0, 59), hour * 60 + minute)


def _shifted(minutes: Column) -> Column:
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return _once(F.pmod(minutes - IST_MINUTES, F.lit(1440)), lambda utc: F.concat(two((utc / 60).cast("int")), two(F.pmod(utc, F.lit(60)))))


def _plain_slots(text: Column) -> Column:
    """ist_sessions of SLOTS slots at most, each of twice four digits: every end has a fixed place, and its own in a table of all times of day."""
    utc = lambda n: (n // 100 * 60 + n % 100 - IST_MINUTES) % 1440
    times = F.split(F.lit(",".join(f"{utc(n) // 60:02}{utc(n) % 60:02}" for n in range(2400))), ",")
    end = lambda at: F.get(times, F.substring(text, at, 4).try_cast("int"))
    slot = lambda i: F.concat(end(10 * i + 1), F.lit("-"), end(10 * i + 6))
    return F.concat_ws("|", *[slot(0), *(F.when(F.length(text) > 10 * i, slot(i)) for i in range(1, SLOTS))])


def ist_to_utc(hhmm: Column) -> Column:
    """HH:MM in India to HH:MM in UTC, empty if it is no time of day."""
    parts = F.split(hhmm, ":")
    text = _shifted(_minutes(F.concat(F.lpad(F.trim(parts[0]), 2, "0"), parts[1])))
    return F.when(F.size(parts) == 2, F.coalesce(F.concat_ws(":", F.substring(text, 1, 2), F.nullif(F.substring(text, 3, 2), F.lit(""))), F.lit(""))).otherwise("")


def ist_sessions(raw: Column) -> Column:
    """HHMM-HHMM|...: to UTC; a bad slot makes the whole empty."""
    trimmed = F.regexp_replace(F.trim(F.coalesce(raw, F.lit(""))), ":+$", "")

    def slot(part):
        s, e = F.split(F.trim(part), "-", 2)[0], F.get(F.split(F.trim(part), "-", 2), F.lit(1))
        return F.concat(_shifted(_minutes(s)), F.lit("-"), _shifted(_minutes(e)))

    text = _once(F.transform(F.split(trimmed, r"\|"), slot), lambda slots: F.when(~F.exists(slots, lambda x: x.isNull()), F.array_join(slots, "|")))
    plain = trimmed.rlike(rf"\A{_SLOT}(\|{_SLOT}){{0,{SLOTS - 1}}}\z")
    return F.when(trimmed == "", "").when(plain, _plain_slots(trimmed)).otherwise(F.coalesce(text, F.lit("")))


def with_pre_open(session: Column, segment: Column) -> Column:
    """The auction before the cash market, in front of a session that is not empty."""
    return F.concat(F.when((F.coalesce(segment, F.lit("")) == "CM") & (session != ""), PRE_OPEN + "|").otherwise(""), session)


def eastern_to_utc(day: Column, hhmm: str) -> Column:
    """The timestamp of a time of day in New York, for a session in UTC."""
    local = F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), F.lit(int(hhmm[:2])), F.lit(int(hhmm[2:])), F.lit(0))
    return F.to_utc_timestamp(local, EASTERN)


def us_session(day: Column, venue: str) -> Column:
    """The slots of a venue on a day; each end is converted on its own date, the next one where a slot passes midnight."""
    text = lambda d, t: F.date_format(eastern_to_utc(d, t), "HHmm")
    return F.concat_ws("|", *[F.concat(text(day, s), F.lit("-"), text(F.date_add(day, int(e <= s)), e)) for s, e in US_SLOTS[venue]])


def option_close_ns(day: Column, is_index: Column) -> Column:
    """Nanoseconds at the end of the last slot on the day that an option expires; one conversion for both kinds."""
    ends = [int(US_SLOTS[v][-1][1][:2]) * 60 + int(US_SLOTS[v][-1][1][2:]) for v in ("xcbo_index", "xcbo_equity")]
    local = F.timestamp_seconds(F.unix_date(day).cast("long") * 86_400 + 60 * F.when(is_index, ends[0]).otherwise(ends[1]))
    return F.unix_seconds(F.to_utc_timestamp(local, EASTERN)) * F.lit(1_000_000_000).cast("long")
