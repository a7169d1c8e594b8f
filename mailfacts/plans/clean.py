"""Clean layer and queue stage of the OCP world."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import Bounds, mst_date
from mailfacts.operators.conform import conform
from mailfacts.plans.build import build_time
from mailfacts.sources import scans, schemas

# Sources that belong to this world.
OCP_SOURCES = (7, 8, 13)


def clean_sends(
    contact_email: DataFrame, customermap: DataFrame, start: str, end: str, build_ts: str
) -> DataFrame:
    """One row per distinct OCP send between ``start`` and ``end``, with its customer.

    Join and distinct share the shuffle by customer.
    """
    sends = scans.raw_sends(contact_email)
    return conform(
        sends.where(Bounds(start, end).within(sends, "sent_mst_ts"))
        .where(F.col("emailsource_id").isin(*OCP_SOURCES))
        .join(scans.customer_map(customermap), "customermap_id")
        .withColumn("sent_mst_date", mst_date("sent_mst_ts")),
        schemas.CLEAN_SENDS,
        constants={"etl_build_mst_ts": build_time(build_ts)},
        distinct=True,
    )


def clean_opens(
    opens: DataFrame, customermap: DataFrame, start: str, end: str, build_ts: str
) -> DataFrame:
    """One row per distinct OCP open between ``start`` and ``end``, with its customer."""
    opens = scans.raw_opens(opens)
    return conform(
        opens.where(Bounds(start, end).within(opens, "open_mst_ts"))
        .join(scans.customer_map(customermap), "customermap_id")
        .withColumn("open_mst_date", mst_date("open_mst_ts")),
        schemas.CLEAN_OPENS,
        constants={"etl_build_mst_ts": build_time(build_ts)},
        distinct=True,
    )


def queued_emails(detail: DataFrame, success: DataFrame, start: str, end: str) -> DataFrame:
    """Queue rows that were sent, apart from seed-list and test mails."""
    detail = scans.queue_detail(detail)
    success = scans.queue_success_templates(success)
    bounds = Bounds(start, end)
    real = (F.col("isautomatedseedlist") == 0) & (F.col("istestsend") == 0)
    return detail.where(real & bounds.within(detail, "emailqueuecreatedate")).join(
        success.where(bounds.within(success, "emailqueuecreatedate")).drop(
            "emailqueuecreatedate"
        ),
        "emailqueueid",
    )


def queue_stage(detail: DataFrame, success: DataFrame, start: str, end: str) -> DataFrame:
    """The queue rows the response fact attributes to."""
    return conform(
        queued_emails(detail, success, start, end).select(
            "messageguid",
            "emailqueueid",
            "templateid",
            "redpointcontactid",
            "privatelabelid",
            F.col("shopperid").alias("email_queue_shopper_id"),
            F.col("sourcecode").alias("email_queue_source_code"),
            F.col("emailqueuecreatedate").alias("emailqueuecreatedate_ts"),
            mst_date("emailqueuecreatedate").alias("email_queue_create_date"),
        ),
        schemas.QUEUE_STAGE,
    )
