"""Joining SFMC sends, their log and the responses to them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mailfacts.functions import (
    Bounds,
    email_key,
    from_year,
    key_tag,
    locale_country,
    locale_language,
    to_mst,
)
from mailfacts.operators.dedupe import keep_matching
from mailfacts.operators.events import in_mst_range
from mailfacts.sources.scans import SFMC_KEYS

TAG = "_tag"


def sent_in_range(sent: DataFrame, bounds: Bounds) -> DataFrame:
    """Sends within MST bounds, timed in MST. They may be stored under any month of their year."""
    return (
        in_mst_range(sent, bounds, from_year(bounds.lo))
        .withColumn("email_send_mst_ts", to_mst("event_utc_ts"))
        .drop("event_utc_ts", "year", "month")
    )


def log_in_range(log: DataFrame, bounds: Bounds) -> DataFrame:
    """Log entries within MST bounds; the time of the send wins over theirs."""
    return in_mst_range(log, bounds, from_year(bounds.lo)).drop("event_utc_ts", "year", "month")


def join_send_log(sent: DataFrame, log: DataFrame) -> DataFrame:
    """Every send, with its log entry where there is one."""
    return sent.join(log, SFMC_KEYS, "left")


def join_responses(events: DataFrame, sent: DataFrame, log: DataFrame) -> DataFrame:
    """Every event, with the send it answers and that send's log entry where known.

    Sends are cut to the emails answered in this run, and meet the log thereafter, so the events are
    read once for that. The tag lets cut and join share one shuffle, and makes the join with the
    events use another that can split an email with very many responses.
    """
    answered = events.select(*SFMC_KEYS).withColumn(TAG, key_tag(*SFMC_KEYS))
    tagged = [*SFMC_KEYS, TAG]
    sent, log = (df.withColumn(TAG, key_tag(*SFMC_KEYS)) for df in (sent, log))
    logged = keep_matching(sent, answered, tagged).join(log, tagged, "left")
    return events.join(logged.drop(TAG), SFMC_KEYS, "left")


def add_email_columns(df: DataFrame) -> DataFrame:
    """Surrogate key and the two halves of the locale."""
    return df.withColumns(
        {
            "email_send_id": email_key(*SFMC_KEYS),
            "email_language_code": locale_language("locale_code"),
            "email_country_code": locale_country("locale_code"),
        }
    )
