"""Date expressions: calendar attributes, retail events and seasonality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seasonal factors, January to December and Monday to Sunday.
MONTH_FACTORS = [0.7, 0.8, 0.9, 1.0, 1.0, 1.0, 1.1, 1.0, 1.1, 1.2, 1.5, 1.8]
WEEKDAY_FACTORS = [0.8, 1.0, 1.1, 1.1, 1.2, 1.0, 0.7]
INDEX_CAP = 2.5

# Fixed values: (month, day) -> (holiday name, seasonal spike); no spike where 0.
HOLIDAYS = {
    (1, 1): ("New Year", 0.3),
    (2, 14): ("Valentine", 0.2),
    (12, 25): ("Christmas", 0.5),
    (12, 31): ("New Year Eve", 0.0),
}
# Spikes of the moving events.
BLACK_FRIDAY_SPIKE = 0.8
CYBER_MONDAY_SPIKE = 0.4

# Season of each month, January to December.
SEASONS = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def date_key(d: Column) -> Column:
    """The date as the integer YYYYMMDD."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def _is_day(d: Column, month: int, day: int) -> Column:
    return (F.month(d) == month) & (F.dayofmonth(d) == day)


def holiday_name(d: Column) -> Column:
    name = F.lit(None).cast("string")
    for (month, day), (label, _) in HOLIDAYS.items():
        name = F.when(_is_day(d, month, day), label).otherwise(name)
    return name


def season(d: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SEASONS)), F.month(d))


def fourth_friday(d: Column) -> Column:
    """Fourth Friday of November in the year of ``d`` (the rule used for Black Friday).

    In years where 1 November is a Friday this is a week before the day after
    Thanksgiving.
    """
    october_end = F.make_date(F.year(d), F.lit(10), F.lit(31))
    return F.date_add(F.next_day(october_end, "FRI"), 21)


def cyber_monday(d: Column) -> Column:
    return F.date_add(fourth_friday(d), 3)


def seasonality_index(d: Column) -> Column:
    """Month factor x weekday factor plus event spikes, at most ``INDEX_CAP``."""
    by_month = F.element_at(F.array(*map(F.lit, MONTH_FACTORS)), F.month(d))
    by_weekday = F.element_at(F.array(*map(F.lit, WEEKDAY_FACTORS)), F.weekday(d) + 1)
    index = by_month * by_weekday
    spikes = [(_is_day(d, *day), s) for day, (_, s) in HOLIDAYS.items() if s]
    spikes += [(d == fourth_friday(d), BLACK_FRIDAY_SPIKE), (d == cyber_monday(d), CYBER_MONDAY_SPIKE)]
    spike = F.lit(0.0)
    for condition, size in spikes:
        spike = spike + F.when(condition, size).otherwise(0.0)
    return F.when(d.isNotNull(), F.least(F.lit(INDEX_CAP), index + spike))
