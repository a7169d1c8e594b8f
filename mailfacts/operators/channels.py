"""Splitting the OCP world into its sending systems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import (
    control_flag,
    effective_source,
    holdout_flag,
    is_redpoint,
    source_system,
)
from mailfacts.functions.labels import REDPOINT


def channel_split(df: DataFrame, mass_mailer: str) -> DataFrame:
    """Classify every row in one pass.

    Needs ``redpointcontactid`` and ``emailsource_id``; reads ``channel_name`` where there is
    one (without it no email is a control). The redpoint override of the source id comes
    first, so an email held back by its source but sent through redpoint counts as sent.
    """
    source = effective_source("redpointcontactid", "emailsource_id")
    return _classify(df.withColumn("emailsource_id", source), mass_mailer)


def channel_split_union(df: DataFrame, mass_mailer: str) -> DataFrame:
    """The same classification as two filtered halves and a union, for comparison.

    Spark plans the input twice here, which is why the plans use ``channel_split``.
    """
    redpoint = is_redpoint("redpointcontactid")
    halves = [
        df.where(redpoint).withColumn("emailsource_id", F.lit(REDPOINT)),
        df.where(~redpoint),
    ]
    return _classify(reduce(DataFrame.unionByName, halves), mass_mailer)


def _classify(df: DataFrame, mass_mailer: str) -> DataFrame:
    channel = F.col("channel_name") if "channel_name" in df.columns else F.lit(None)
    held_out = holdout_flag("emailsource_id")
    return df.withColumns(
        {
            "email_source_system_name": source_system("emailsource_id", mass_mailer),
            "email_holdout_flag": held_out,
            "email_control_flag": control_flag(channel.cast("string")),
            "email_sent_flag": ~held_out,
        }
    )
