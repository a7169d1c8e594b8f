"""The send fact of both worlds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import Bounds, email_key, locale_country, locale_language, mst_date
from mailfacts.functions.labels import MASS_MAILER_IN_SENDS, SFMC_SYSTEM
from mailfacts.operators.channels import channel_split
from mailfacts.operators.conform import conform
from mailfacts.operators.customers import add_customer
from mailfacts.operators.dedupe import distinct_keys
from mailfacts.operators.sfmc import (
    add_email_columns,
    join_send_log,
    log_in_range,
    sent_in_range,
)
from mailfacts.plans.build import build_time
from mailfacts.plans.clean import queued_emails
from mailfacts.sources import scans, schemas

# Columns each world does not know.
ABSENT_OCP = ["exclude_reason_desc", "campaign_id", "segment_id", "channel_id", "email_name"]
ABSENT_SFMC = [
    "email_id",
    "email_message_guid",
    "email_source_lead_id",
    "email_source_key",
    "template_name",
    "email_holdout_flag",
    "email_control_flag",
    "shopper_email_domain_name",
]


def queued_sends(
    sends: DataFrame, detail: DataFrame, success: DataFrame, start: str, queue_start: str, end: str
) -> DataFrame:
    """Clean sends with the redpoint contact of their queue row.

    The contacts of a message are made distinct first: joining a message sent many times with
    as many equal queue rows would multiply them.
    """
    queued = queued_emails(detail, success, queue_start, end).select(
        F.col("messageguid").alias("message_id"),
        F.col("templateid").alias("template_id"),
        "redpointcontactid",
    )
    queued = distinct_keys(queued, queued.columns)
    in_range = Bounds(start, end, closed=False).within(sends, "sent_mst_date")
    return sends.where(in_range).join(queued, ["message_id", "template_id"])


def send_fact_ocp(
    sends: DataFrame,
    detail: DataFrame,
    success: DataFrame,
    templates: DataFrame,
    shoppers: DataFrame,
    start: str,
    queue_start: str,
    end: str,
    build_ts: str,
    mass_mailer: str = MASS_MAILER_IN_SENDS,
) -> DataFrame:
    """One row per OCP-world send that was queued.

    ``start`` to before ``end`` bounds the send date, ``queue_start`` to ``end`` the queue
    time. The two queue kinds are classified in one pass and duplicates removed once, at the
    end, in the shuffle of the shopper join.
    """
    queued = queued_sends(sends, detail, success, start, queue_start, end)
    # What follows from a row is added after the joins, so that they do not shuffle it.
    joined = (
        queued.withColumn("template_id", F.col("template_id").cast("string"))
        .join(scans.templates(templates), "template_id", "left")
        .join(scans.shoppers(shoppers), "shopper_id", "left")
    )
    fact = (
        channel_split(joined, mass_mailer)
        .withColumns(
            {
                "isc_source_code": F.lower("isc_code"),
                "email_language_code": locale_language("language_code"),
                "email_country_code": locale_country("language_code"),
            }
        )
        .withColumnsRenamed(
            {
                "message_id": "email_message_guid",
                "sent_mst_ts": "email_send_mst_ts",
                "sent_mst_date": "email_send_mst_date",
                "redpointcontactid": "email_source_lead_id",
                "emailsourcekey": "email_source_key",
                "privatelabel_id": "private_label_id",
            }
        )
        .withColumn(
            "email_send_id",
            email_key("email_message_guid", "shopper_id", "isc_source_code", "template_id"),
        )
    )
    built = {"etl_build_mst_ts": build_time(build_ts)}
    return conform(fact, schemas.SEND_FACT, ABSENT_OCP, built, distinct=True)


def send_fact_sfmc(
    sent: DataFrame,
    log: DataFrame,
    exclusion_list: DataFrame,
    customers: DataFrame,
    shoppers: DataFrame,
    start: str,
    end: str,
    build_ts: str,
) -> DataFrame:
    """One row per SFMC send between ``start`` and ``end``.

    ``customers`` is one build of the customer table.
    """
    bounds = Bounds(start, end)
    entries = log_in_range(scans.sfmc_send_log(log), bounds)
    logged = join_send_log(sent_in_range(scans.sfmc_sent(sent), bounds), entries)
    fact = add_email_columns(
        add_customer(
            logged,
            exclusion_list,
            scans.customers(customers),
            scans.shoppers(shoppers),
            wanted=entries,
        )
    ).withColumn("email_send_mst_date", mst_date("email_send_mst_ts"))
    constants = {
        "email_sent_flag": F.lit(True),
        "email_source_system_name": F.lit(SFMC_SYSTEM),
        "etl_build_mst_ts": build_time(build_ts),
    }
    return conform(fact, schemas.SEND_FACT, ABSENT_SFMC, constants, distinct=True)
