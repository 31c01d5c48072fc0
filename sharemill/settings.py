"""Switches for behaviour that has more than one sensible answer. Defaults keep the established results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CleanSettings:
    """How the weekly feeds are cleaned.

    numbers        "strict" fails the job on a value that is no number (NULL included); "lenient" gives NULL
    python_numbers accept exactly the texts Python's ``float`` accepts (``1_000`` yes, ``12d`` no)
    ignore_case    exclude ``(NA)`` as well as ``(na)``
    drop_zero      really drop rows whose share is zero from the genre feed
    slice_genre    cut the genre feed to the as-of week, as the channel feed is
    normalise_key  join both feeds on trimmed, case-insensitive channel names
    unique_master  fail if a master key (under the join's own comparison) occurs twice
    """

    numbers: str = "strict"
    python_numbers: bool = False
    ignore_case: bool = False
    drop_zero: bool = False
    slice_genre: bool = False
    normalise_key: bool = False
    unique_master: bool = False


@dataclass(frozen=True)
class MartSettings:
    """How the marts treat periods and odd values.

    calendar       "compat": 52 * year + week, which merges week 53 with the next week 1; "iso": true week count
    trailing       number of weeks before the current one that are averaged
    ytd_week       first week of the year-to-date average
    ytd_upper      None leaves year-to-date open above; "asof" ends it at the current week
    prune_history  read only the periods some measure needs; groups without rows there disappear
    year_folder    partition column that holds the same year as year_of_week in every row; pruning then skips folders
    null_measures  "keep" lets a NULL measure through; "fail" stops the job
    overflow       "raise" or "null" when a measure does not fit DECIMAL(18,7)
    """

    calendar: str = "compat"
    trailing: int = 4
    ytd_week: int = 14
    ytd_upper: str | None = None
    prune_history: bool = False
    year_folder: str | None = None
    null_measures: str = "keep"
    overflow: str = "raise"
