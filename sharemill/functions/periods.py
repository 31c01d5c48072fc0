"""Weekly period arithmetic: a linear index over weeks and the windows a report looks at."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from sharemill.asof import AsOf
from sharemill.settings import MartSettings

EPOCH_MONDAY = date(1970, 1, 5)


def period_index(year: Column, week: Column, calendar: str = "compat") -> Column:
    """Position of a week on one line, as int. ``compat`` is 52 * year + week; ``iso`` counts real weeks."""
    if calendar == "compat":
        return (year * 52 + week).cast("int")
    if calendar != "iso":
        raise ValueError(f"calendar must be 'compat' or 'iso', got {calendar!r}")
    # 4 January always lies in ISO week 1
    first_monday = F.trunc(F.make_date(year.cast("int"), F.lit(1), F.lit(4)), "week")
    weeks_to_first = F.datediff(first_monday, F.lit(EPOCH_MONDAY)) / 7
    return (weeks_to_first + week - 1).cast("int")


def index_of(year: int, week: int, calendar: str = "compat") -> int:
    """The same index for known numbers."""
    if calendar == "compat":
        return 52 * year + week
    if calendar != "iso":
        raise ValueError(f"calendar must be 'compat' or 'iso', got {calendar!r}")
    return (date.fromisocalendar(year, 1, 1) - EPOCH_MONDAY).days // 7 + week - 1


def oldest_year(index: int, calendar: str = "compat") -> int:
    """The earliest year a week at or after ``index`` can be counted in, with week numbers up to 53."""
    if calendar == "compat":
        return -(-(index - 53) // 52)
    year = (EPOCH_MONDAY + timedelta(weeks=index)).isocalendar().year
    # a week 53 in a year of 52 weeks has the index of the next year's first week
    return year - 1 if index_of(year - 1, 53, "iso") >= index else year


@dataclass(frozen=True)
class Windows:
    """Index bounds, all inclusive; ``ytd_to`` None is open."""

    current: int
    trailing_from: int
    trailing_to: int
    ytd_from: int
    ytd_to: int | None

    @classmethod
    def at(cls, asof: AsOf, settings: MartSettings = MartSettings()) -> Windows:
        if settings.ytd_upper not in (None, "asof"):
            raise ValueError(f"ytd_upper must be None or 'asof', got {settings.ytd_upper!r}")
        current = index_of(asof.year, asof.week, settings.calendar)
        return cls(
            current=current,
            trailing_from=current - settings.trailing,
            trailing_to=current - 1,
            ytd_from=index_of(asof.year, settings.ytd_week, settings.calendar),
            ytd_to=current if settings.ytd_upper == "asof" else None,
        )

    def is_current(self, index: Column) -> Column:
        return index == self.current

    def is_trailing(self, index: Column) -> Column:
        return index.between(self.trailing_from, self.trailing_to)

    def is_year_to_date(self, index: Column) -> Column:
        return index >= self.ytd_from if self.ytd_to is None else index.between(self.ytd_from, self.ytd_to)

    def is_needed(self, index: Column) -> Column:
        """Whether any measure looks at this period."""
        return self.is_current(index) | self.is_trailing(index) | self.is_year_to_date(index)


def week_before(day: Column) -> tuple[Column, Column]:
    """ISO year and week of ``day`` minus one, within the same ISO year: week 1 gives week 0. NULL for NULL."""
    return F.extract(F.lit("yearofweek"), day).cast("int"), F.weekofyear(day) - 1


def previous_iso_week(day: Column) -> tuple[Column, Column]:
    """ISO year and week of the day seven days before: week 1 gives week 52 or 53 of the year before."""
    earlier = F.date_sub(day, 7)
    return F.extract(F.lit("yearofweek"), earlier).cast("int"), F.weekofyear(earlier)
