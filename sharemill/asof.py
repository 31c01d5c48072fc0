"""The as-of period: which week a run reports on."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class AsOf:
    """An (ISO year, week) pair. Week 0 is allowed: it means "the week before week 1" in index arithmetic."""

    year: int
    week: int

    def __post_init__(self) -> None:
        if not 0 <= self.week <= 53:
            raise ValueError(f"week must be between 0 and 53, got {self.week}")

    @classmethod
    def parse(cls, text: str) -> AsOf:
        """Read ``1998-W40``."""
        match = re.fullmatch(r"(\d{4})-W(\d{1,2})", text.strip())
        if match is None:
            raise ValueError(f"expected YYYY-Www, got {text!r}")
        return cls(int(match[1]), int(match[2]))

    @classmethod
    def week_before(cls, day: date) -> AsOf:
        """ISO week of ``day`` minus one, within the same ISO year: week 1 gives week 0."""
        year, week, _ = day.isocalendar()
        return cls(year, week - 1)

    @classmethod
    def previous_iso_week(cls, day: date) -> AsOf:
        """The real ISO week before ``day``: week 1 gives week 52 or 53 of the year before."""
        year, week, _ = (day - timedelta(days=7)).isocalendar()
        return cls(year, week)

    def __str__(self) -> str:
        return f"{self.year}-W{self.week:02d}"
