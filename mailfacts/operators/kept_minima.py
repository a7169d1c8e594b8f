"""First-response flags from kept minima: a run reads its own days and a narrow table, not the history.

The kept table has a row (email, type, earliest time, its day) for each time a run found an email's first
response of a type, or an earlier one. Runs only append to it; the smallest row of a group counts. A run
flags its own days, lowers minima for responses that came late, and rewrites the stored days whose
first responses are thereby no longer first. Runs in any order leave the same flags as one run
over everything.

Two things it does not see: a stored day replaced by one without its earliest response (minima never
rise; build the table anew with ``minima_of`` then), and rows whose day is not that of their time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import key_tag
from mailfacts.functions.time import Bounds
from mailfacts.operators.dedupe import keep_matching
from mailfacts.operators.first_response import DATE, FIRST, FLAG_CODES, GROUP, TS, flags_of, own_responses

DAY = "_first_day"
_BEFORE, _DAY_BEFORE = "_before", "_day_before"
# Name and type of the kept table's columns.
MINIMA = [*GROUP, FIRST, DAY]


def _known(responses: DataFrame) -> DataFrame:
    """Rows that can be late or make others late."""
    return responses.where(" and ".join(f"{name} is not null" for name in [*GROUP, TS]))


def _smallest(rows: DataFrame, time: str, day: str) -> DataFrame:
    """The earliest time of each group and its day; also grouped by a hash, so that a join with hot
    keys can be split."""
    tagged = rows.groupBy(*GROUP, key_tag(*GROUP).alias("_tag"))
    return tagged.agg(F.min(time).alias(FIRST), F.min_by(day, time).alias(DAY)).select(*MINIMA)


def minima_of(responses: DataFrame) -> DataFrame:
    """The kept table of a whole history, to start from."""
    return _smallest(_known(own_responses(responses)), TS, DATE)


def smallest_kept(kept: DataFrame) -> DataFrame:
    """One row per group, as if the kept table had been written at once."""
    return _smallest(kept, FIRST, DAY)


@dataclass(frozen=True)
class FlagRun:
    """``rows`` replace the stored days they belong to; ``minima`` are appended to the kept table."""

    rows: DataFrame
    minima: DataFrame


def _not_late(late: Column) -> dict[str, Column]:
    return {flag: F.col(flag) & ~F.coalesce(late, F.lit(False)) for flag in FLAG_CODES}


def flag_with_minima(stored: DataFrame, kept: DataFrame, start: str, end: str) -> FlagRun:
    """Flag the stored days ``start`` to ``end``, which are new to ``kept``, and mend older flags.

    ``kept`` is cut to the groups of these days before it is reduced. Only the days of minima that went
    down are read and rewritten besides the run's own; a join on the day prunes all others.
    """
    own = own_responses(stored)
    bounds = Bounds(start, end)
    rows = own.where(bounds.within(own, DATE))
    fresh = _smallest(_known(rows), TS, DATE)
    known = smallest_kept(keep_matching(kept.select(*MINIMA), fresh.select(*GROUP), GROUP))
    before = known.withColumnsRenamed({FIRST: _BEFORE, DAY: _DAY_BEFORE})
    met = fresh.join(before, GROUP, "left")
    earliest = met.select(*GROUP, F.least(FIRST, _BEFORE).alias(FIRST))
    improved = met.where(F.col(_BEFORE).isNull() | (F.col(FIRST) < F.col(_BEFORE)))
    lowered = improved.where(F.col(_BEFORE).isNotNull())

    flagged = (
        rows.join(earliest, GROUP, "left")
        .withColumns(flags_of(F.coalesce(F.col(TS) > F.col(FIRST), F.lit(False))))
        .select(*stored.columns)
        .distinct()
    )
    days = lowered.select(F.col(_DAY_BEFORE).alias(DATE)).distinct()
    others = own.where(~F.coalesce(bounds.within(own, DATE), F.lit(False)))
    mended = (
        others.join(days, DATE, "left_semi")
        .join(lowered.select(*GROUP, FIRST), GROUP, "left")
        .withColumns(_not_late(F.col(TS) > F.col(FIRST)))
        .select(*stored.columns)
    )
    return FlagRun(flagged.unionByName(mended), improved.select(*MINIMA))
