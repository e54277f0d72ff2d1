"""Sessions of the US exchanges by rule, as column expressions for any range of days: moving feasts, observed days, early closes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Closures that no rule gives, and the first years of two holidays.
CLOSED = ["1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09"]
FIRST_KING, FIRST_JUNETEENTH = 1998, 2022
MONDAY, THURSDAY, FRIDAY, SATURDAY, SUNDAY = 0, 3, 4, 5, 6


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year."""
    whole = lambda a, b: F.floor(a / b)
    golden, century, rest = year % 19, whole(year, 100), year % 100
    moon = (19 * golden + century - whole(century, 4) - whole(century - whole(century + 8, 25) + 1, 3) + 15) % 30
    week = (32 + 2 * (century % 4) + 2 * whole(rest, 4) - moon - rest % 4) % 7
    days = moon + week - 7 * whole(golden + 11 * moon + 22 * week, 451) + 114
    return F.make_date(year, whole(days, 31).cast("int"), (days % 31 + 1).cast("int"))


def nth(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th given weekday of a month; -1 is the last one."""
    if n < 0:
        last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
        return F.date_sub(last, F.pmod(F.weekday(last) - weekday, F.lit(7)))
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1))


def observed(year: Column, month: int, day: int, saturday: bool = True) -> Column:
    """A fixed day, on Monday where it is a Sunday, and on Friday where it is a Saturday, if that is kept at all."""
    d = F.make_date(year, F.lit(month), F.lit(day))
    return F.when(F.weekday(d) == SUNDAY, F.date_add(d, 1)).when(F.weekday(d) == SATURDAY, F.date_sub(d, 1) if saturday else F.lit(None).cast("date")).otherwise(d)


def holidays(year: Column) -> list:
    """The days of a year on which the exchanges are closed by rule, null where a rule did not hold yet."""
    return [
        observed(year, 1, 1, saturday=False), F.when(year >= FIRST_KING, nth(year, 1, MONDAY, 3)), nth(year, 2, MONDAY, 3), F.date_sub(easter(year), 2), nth(year, 5, MONDAY, -1),
        F.when(year >= FIRST_JUNETEENTH, observed(year, 6, 19)), observed(year, 7, 4), nth(year, 9, MONDAY, 1), nth(year, 11, THURSDAY, 4), observed(year, 12, 25),
    ]


def is_us_session(day: Column) -> Column:
    """Whether the US exchanges trade on a day; null for null."""
    closed = F.exists(F.array_compact(F.array(*holidays(F.year(day)))), lambda h: h == day) | day.isin([F.lit(c).cast("date") for c in CLOSED])
    return (F.weekday(day) < SATURDAY) & ~closed


def closes_early(day: Column) -> Column:
    """Whether the session of a day ends at 13:00 in New York: before Independence Day and Christmas, and after Thanksgiving."""
    year, eve = F.year(day), F.date_format(day, "MM-dd")
    return is_us_session(day) & (eve.isin("07-03", "12-24") | (day == F.date_add(nth(year, 11, THURSDAY, 4), 1)))
