"""Fixed-offset time and range predicates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mountain standard time all year, no daylight saving.
MST_HOURS_BEHIND_UTC = 7


def _offset() -> Column:
    return F.make_dt_interval(hours=F.lit(MST_HOURS_BEHIND_UTC))


def to_mst(utc: Column | str) -> Column:
    """Shift a UTC time to MST. Keeps the column's timestamp type."""
    utc = F.col(utc) if isinstance(utc, str) else utc
    return utc - _offset()


def mst_date(mst: Column | str) -> Column:
    """``yyyy-MM-dd`` text of a time already in MST.

    Two casts instead of a formatter: the same text, but independent of the session zone.
    """
    mst = F.col(mst) if isinstance(mst, str) else mst
    return mst.cast("date").cast("string")


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


@dataclass(frozen=True)
class Bounds:
    """A range given as text, with or without its upper end.

    A bare date stands for its midnight, so a closed range on a timestamp keeps of the last
    day only that instant.
    """

    lo: str
    hi: str
    closed: bool = True

    def within(self, df: DataFrame, column: str) -> Column:
        """Predicate on a plain column of ``df``, with literals of that column's own type.

        Equal types leave the column bare in the plan, so that the scan can prune by it.
        """
        dtype = df.schema[column].dataType
        lo, hi = (F.lit(text).cast(dtype) for text in (self.lo, self.hi))
        below = F.col(column) <= hi if self.closed else F.col(column) < hi
        return (F.col(column) >= lo) & below

    def mst_to_utc(self) -> Bounds:
        """The same range for a column still in UTC.

        Testing the stored UTC column against shifted literals keeps the range usable for
        scan pruning, which a test on the shifted column is not.
        """
        shift = timedelta(hours=MST_HOURS_BEHIND_UTC)
        lo, hi = ((_moment(text) + shift).isoformat(sep=" ") for text in (self.lo, self.hi))
        return Bounds(lo, hi, self.closed)


def _year_month(text: str) -> tuple[int, int]:
    moment = _moment(text)
    return moment.year, moment.month


def from_year(lo: str, year: Column | str = "year") -> Column:
    """Year partitions at or after that of ``lo``."""
    return _as_int(year) >= _year_month(lo)[0]


def _as_int(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("int")


def from_year_month(
    lo: str, year: Column | str = "year", month: Column | str = "month"
) -> Column:
    """(year, month) partitions at or after that of ``lo``, compared as a pair.

    Testing year and month separately would drop January when ``lo`` lies in December. There
    is no upper end: an event may be stored under a later month than its own.
    """
    first_year, first_month = _year_month(lo)
    year, month = _as_int(year), _as_int(month)
    return (year > first_year) | ((year == first_year) & (month >= first_month))
