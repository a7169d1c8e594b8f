"""Campaign, template and holdout dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.functions import mst_date, to_mst
from mailfacts.operators.conform import conform
from mailfacts.operators.dedupe import distinct_keys, keep_matching, latest_per_key
from mailfacts.plans.build import build_time
from mailfacts.sources import scans, schemas

# Names the campaign dimension gives to metadata columns.
CAMPAIGN_NAMES = {
    "cms_omni_campaign_id": "campaign_id",
    "cms_omni_segment_id": "segment_id",
    "cms_omni_channel_id": "channel_id",
    "channel_name": "campaign_channel_name",
    "internal_source_code": "campaign_internal_source_code",
    "email_optin_status_name": "campaign_optin_preference_desc",
    "control_flag": "campaign_control_flag",
    "test_flag": "campaign_test_flag",
    "three_day_suppression_flag": "campaign_three_day_suppression_flag",
    "test_type_name": "campaign_test_type_desc",
    "international_flag": "campaign_international_flag",
    "product_name": "campaign_product_desc",
    "product_content_name": "campaign_product_content_desc",
    "revenue_flag": "campaign_revenue_generating_flag",
    "objective_name": "campaign_objective_desc",
    "subobjective_name": "campaign_subobjective_desc",
    "category_name": "campaign_category_name",
    "subcategory_name": "campaign_subcategory_name",
    "friendly_name": "campaign_friendly_name",
    "campaign_classification_name": "campaign_classification_desc",
    "campaign_group_name": "campaign_group_desc",
    "message_classification_name": "campaign_message_classification",
    "send_type_name": "campaign_trigger_type_desc",
}
CAMPAIGN_ID = "cms_omni_campaign_id"
SEGMENT_ID = "cms_omni_segment_id"
CHANNEL_ID = "cms_omni_channel_id"


def _built(build_ts: str) -> dict[str, Column]:
    built = build_time(build_ts)
    return {"etl_build_mst_ts": built, "etl_build_mst_date": mst_date(built)}


def _undated(df: DataFrame) -> DataFrame:
    """What any stored day says, once: joining repeated days would multiply them."""
    wanted = [c for c in df.columns if CAMPAIGN_NAMES.get(c, c) in schemas.CAMPAIGN_DIM.fieldNames()]
    return df.select(*wanted).distinct()


def dim_campaign(
    campaigns: DataFrame,
    channels: DataFrame,
    utms: DataFrame,
    segments: DataFrame,
    build_ts: str,
) -> DataFrame:
    """One row per distinct channel, utm, segment and campaign combination."""
    star = (
        _undated(channels)
        .join(_undated(segments), SEGMENT_ID)
        .join(_undated(campaigns), CAMPAIGN_ID)
        .join(_undated(utms), CHANNEL_ID)
        .withColumnsRenamed(CAMPAIGN_NAMES)
    )
    return conform(
        star,
        schemas.CAMPAIGN_DIM,
        absent=["campaign_gho_filter_applied_flag"],
        constants=_built(build_ts),
        distinct=True,
    )


def dim_template(template_metadata: DataFrame, build_ts: str) -> DataFrame:
    """The latest name of every email template."""
    versions = scans.template_versions(template_metadata).withColumn(
        "create_mst_ts", to_mst("create_utc_ts")
    )
    latest = latest_per_key(versions.drop("create_utc_ts"), ["email_id"], ["create_mst_ts"])
    return conform(latest, schemas.TEMPLATE_DIM, constants=_built(build_ts))


def dim_holdout(
    holdout: DataFrame, customers: DataFrame, year: str, month: str, day: str, build_ts: str
) -> DataFrame:
    """Customers held out of a campaign, from one snapshot.

    ``customers`` is one build of the customer table.
    """
    snapshot = (
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    )
    chosen = scans.holdouts(holdout).where(snapshot)
    met = keep_matching(
        scans.customers(customers), chosen.select("customer_id"), ["customer_id"]
    )
    held_out = (
        chosen.withColumn("campaign_selection_mst_ts", to_mst("etl_build_utc_ts"))
        .withColumn("snap_date", mst_date("campaign_selection_mst_ts"))
        .join(distinct_keys(met, met.columns), "customer_id", "left")
    )
    built = {"etl_build_mst_ts": build_time(build_ts)}
    return conform(held_out, schemas.HOLDOUT_DIM, constants=built, distinct=True)
