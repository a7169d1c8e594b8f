"""The response fact of both worlds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import Bounds, email_key, locale_country, locale_language, mst_date
from mailfacts.functions.labels import MASS_MAILER_IN_RESPONSES, SFMC_SYSTEM
from mailfacts.operators.attribution import (
    click_attribution,
    open_attribution,
    tracked_clicks,
)
from mailfacts.operators.channels import channel_split
from mailfacts.operators.conform import conform
from mailfacts.operators.content import add_content, content_hierarchy
from mailfacts.operators.customers import add_customer
from mailfacts.operators.events import conform_events
from mailfacts.operators.sfmc import (
    add_email_columns,
    join_responses,
    log_in_range,
    sent_in_range,
)
from mailfacts.plans.build import build_time
from mailfacts.sources import scans, schemas
from mailfacts.sources.steps import Keep, as_planned

# Columns each world does not know.
ABSENT_OCP = [
    "first_open_flag",
    "first_click_flag",
    "first_complaint_flag",
    "exclude_reason_desc",
    "response_url_text",
    "campaign_id",
    "segment_id",
    "channel_id",
    "email_name",
]
ABSENT_SFMC = [
    "email_id",
    "email_message_guid",
    "content_block_id",
    "content_block_key_id",
    "content_block_key_name",
    "content_block_category_id",
    "content_block_category_name",
    "content_block_subcategory_id",
    "content_block_subcategory_name",
    "content_block_click_eid_text",
    "content_block_click_visit_guid",
    "content_block_click_visitor_guid",
    "template_name",
    "email_control_flag",
    "shopper_email_domain_name",
]

# The kept results of ``ocp_responses`` that its own result still reads.
ATTRIBUTED = ("answered", "followed")


@dataclass(frozen=True)
class ResponseDates:
    """Bounds of an OCP response run, as MST text."""

    open_start: str
    open_end: str
    queue_start: str
    click_queue_start: str
    send_start: str
    end: str


def ocp_responses(
    sends: DataFrame,
    opens: DataFrame,
    stage: DataFrame,
    success: DataFrame,
    tracking: DataFrame,
    clicks: DataFrame,
    dates: ResponseDates,
    content: DataFrame | None = None,
    keep: Keep = as_planned,
) -> DataFrame:
    """Attributed opens and clicks in one shape.

    Range ends differ by table: open and send dates stop before theirs, all others include it.
    ``content`` adds the block hierarchy. Only clicks have a block, so only they are joined
    with it, and opens get its columns as nulls. ``keep`` (``sources.steps``) hands on what is a step of a
    large run: ``tracked`` clicks, their ``queued`` rows, and the two ``ATTRIBUTED`` parts that are put together.
    """
    history = Bounds(dates.send_start, dates.end, closed=False)
    sends = sends.where(history.within(sends, "sent_mst_date"))
    stage = stage.where(
        Bounds(dates.send_start, dates.end).within(stage, "email_queue_create_date")
    )
    clicks = scans.click_tracking(clicks)
    tracking = scans.success_tracking(tracking)
    success = scans.queue_success_ids(success)
    queued = Bounds(dates.queue_start, dates.end)
    clicked = Bounds(dates.open_start, dates.open_end)
    click_queue = Bounds(dates.click_queue_start, dates.end)
    tracked = tracked_clicks(
        clicks.where(clicked.within(clicks, "email_response_mst_ts")),
        tracking.where(queued.within(tracking, "emailqueuecreatedate")),
        success.where(queued.within(success, "emailqueuecreatedate")),
    )
    followed = click_attribution(
        keep("tracked", tracked),
        stage.where(click_queue.within(stage, "email_queue_create_date")),
        sends.where(click_queue.within(sends, "sent_mst_ts")),
        keep=keep,
    )
    if content is not None:
        followed = add_content(followed, content)
    followed = keep("followed", followed)

    opened = Bounds(dates.open_start, dates.open_end, closed=False)
    opens = opens.where(opened.within(opens, "open_mst_date"))
    answered = keep("answered", open_attribution(opens, sends, stage))
    return answered.unionByName(followed, allowMissingColumns=True)


def response_fact_ocp(
    sends: DataFrame,
    opens: DataFrame,
    stage: DataFrame,
    success: DataFrame,
    tracking: DataFrame,
    clicks: DataFrame,
    templates: DataFrame,
    block_keys: DataFrame,
    block_subcategories: DataFrame,
    block_categories: DataFrame,
    shoppers: DataFrame,
    dates: ResponseDates,
    build_ts: str,
    mass_mailer: str = MASS_MAILER_IN_RESPONSES,
    keep: Keep = as_planned,
) -> DataFrame:
    """One row per distinct OCP open or click.

    The first-response flags stay null until ``flag_first_response`` has seen the history.
    """
    content = content_hierarchy(
        scans.block_keys(block_keys),
        scans.block_subcategories(block_subcategories),
        scans.block_categories(block_categories),
    )
    responses = ocp_responses(sends, opens, stage, success, tracking, clicks, dates, content, keep)
    # What follows from a row is added after the joins, so that they do not shuffle it.
    joined = (
        responses.withColumn("template_id", F.col("template_id").cast("string"))
        .join(scans.templates(templates), "template_id", "left")
        .join(scans.shoppers(shoppers), "shopper_id", "left")
    )
    fact = (
        channel_split(joined, mass_mailer)
        .withColumns(
            {
                "isc_source_code": F.lower("isc_code"),
                "email_send_mst_date": mst_date("sent_mst_ts"),
                "email_language_code": locale_language("language_code"),
                "email_country_code": locale_country("language_code"),
                "response_link_context_text": F.col("content_block_click_eid_text"),
                "response_link_name": F.col("content_block_key_name"),
            }
        )
        .withColumnsRenamed(
            {
                "message_id": "email_message_guid",
                "sent_mst_ts": "email_send_mst_ts",
                "privatelabel_id": "private_label_id",
            }
        )
        .withColumn(
            "email_send_id",
            email_key("email_message_guid", "shopper_id", "isc_source_code", "template_id"),
        )
    )
    built = {"etl_build_mst_ts": build_time(build_ts)}
    return conform(fact, schemas.RESPONSE_FACT, ABSENT_OCP, built, distinct=True)


def response_fact_sfmc(
    events: Mapping[str, DataFrame],
    sent: DataFrame,
    log: DataFrame,
    exclusion_list: DataFrame,
    customers: DataFrame,
    shoppers: DataFrame,
    open_start: str,
    open_end: str,
    send_start: str,
    end: str,
    build_ts: str,
) -> DataFrame:
    """One row per SFMC response event. Equal events are separate responses and all stay.

    ``events`` maps the kinds of ``operators.events.EVENT_KINDS`` to their tables.
    """
    responses = conform_events(events, Bounds(open_start, open_end), end)
    history = Bounds(send_start, end)
    entries = log_in_range(scans.sfmc_send_log(log), history)
    joined = join_responses(
        responses, sent_in_range(scans.sfmc_sent(sent), history), entries
    )
    fact = add_email_columns(
        add_customer(
            joined,
            exclusion_list,
            scans.customers(customers),
            scans.shoppers(shoppers),
            wanted=entries,
        )
    ).withColumns(
        {
            "email_send_mst_date": mst_date("email_send_mst_ts"),
            "email_response_mst_date": mst_date("email_response_mst_ts"),
        }
    )
    constants = {
        "email_source_system_name": F.lit(SFMC_SYSTEM),
        "etl_build_mst_ts": build_time(build_ts),
    }
    return conform(fact, schemas.RESPONSE_FACT, ABSENT_SFMC, constants)
