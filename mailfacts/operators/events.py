"""One shape for the five kinds of SFMC response events."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import Bounds, bounce_code, from_year_month, to_mst
from mailfacts.operators.conform import conform
from mailfacts.sources.schemas import CONFORMED_EVENT
from mailfacts.sources.scans import SFMC_KEYS


@dataclass(frozen=True)
class EventKind:
    """How one event table becomes responses."""

    type_column: str = "event_type_code"
    # Constant response code; None means the initials of the type.
    code: str | None = None
    # Flag the table's own ``event_unique_flag`` is stored in.
    unique_flag: str | None = None
    has_links: bool = False
    # Kept up to the end of the whole run instead of the end of the response window.
    until_run_end: bool = False


# Tables, codes and flags of the response kinds.
EVENT_KINDS = {
    "open": EventKind(code="o", unique_flag="first_open_flag"),
    "bounce": EventKind(type_column="bounce_category", until_run_end=True),
    "click": EventKind(code="c", unique_flag="first_click_flag", has_links=True),
    "spam": EventKind(code="s"),
    "unsubscribe": EventKind(code="u"),
}
LINK_COLUMNS = {
    "response_url_text": "url",
    "response_link_name": "link_name",
    "response_link_context_text": "link_content",
}


def in_mst_range(df: DataFrame, bounds: Bounds, stored_from: Column) -> DataFrame:
    """Rows of a UTC event table within MST bounds, of the partitions ``stored_from`` keeps.

    Tested on the stored columns: whole partitions first, then the exact time, so that both
    prune the scan.
    """
    return df.where(stored_from).where(bounds.mst_to_utc().within(df, "event_utc_ts"))


def conform_kind(df: DataFrame, kind: EventKind, bounds: Bounds) -> DataFrame:
    """One event table within MST bounds, in the shape of ``CONFORMED_EVENT``."""
    response_type = F.lower(kind.type_column)
    columns: dict[str, Column] = {
        "email_response_type": response_type,
        "email_response_code": F.lit(kind.code) if kind.code else bounce_code(response_type),
        "email_response_mst_ts": to_mst("event_utc_ts"),
    }
    if kind.unique_flag:
        columns[kind.unique_flag] = F.col("event_unique_flag")
    if kind.has_links:
        columns |= {name: F.col(source) for name, source in LINK_COLUMNS.items()}
    given = {*SFMC_KEYS, *columns}
    return conform(
        in_mst_range(df, bounds, from_year_month(bounds.lo)).select(
            *SFMC_KEYS, *(column.alias(name) for name, column in columns.items())
        ),
        CONFORMED_EVENT,
        absent=[name for name in CONFORMED_EVENT.fieldNames() if name not in given],
    )


def conform_events(
    tables: Mapping[str, DataFrame], window: Bounds, run_end: str
) -> DataFrame:
    """All events of all kinds. Equal events are separate responses and all stay."""
    until_run_end = Bounds(window.lo, run_end, window.closed)
    return reduce(
        DataFrame.unionByName,
        (
            conform_kind(tables[name], kind, until_run_end if kind.until_run_end else window)
            for name, kind in EVENT_KINDS.items()
        ),
    )
