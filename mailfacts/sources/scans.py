"""Projections of the source tables: the columns the plans use, under their working names.

Each takes the source as a DataFrame (a catalog table or files, as the caller likes) and only
selects, so that Spark still prunes columns and pushes later filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailfacts.functions import null_sentinel

# The natural key of one email on the SFMC side.
SFMC_KEYS = ["sfmc_job_id", "sfmc_list_id", "sfmc_batch_id", "sfmc_subscriber_id"]


# --- OCP contact tables ---------------------------------------------------------------------


def customer_map(df: DataFrame) -> DataFrame:
    return df.select(
        "customermap_id",
        null_sentinel("shopperid").alias("shopper_id"),
        null_sentinel("emaildomain").alias("shopper_email_domain_name"),
    )


def raw_sends(df: DataFrame) -> DataFrame:
    return df.select(
        "customermap_id",
        "email_id",
        "message_id",
        F.col("sentdate").alias("sent_mst_ts"),
        "emailsourcekey",
        "template_id",
        "emailsource_id",
        F.col("lang").alias("language_code"),
        null_sentinel("isccode").alias("isc_code"),
        "privatelabel_id",
    )


def raw_opens(df: DataFrame) -> DataFrame:
    return df.select(
        "email_open_id",
        "message_id",
        null_sentinel("isccode").alias("isc_code"),
        "template_id",
        F.col("opendate").alias("open_mst_ts"),
        F.col("lang").alias("language_code"),
        "privatelabel_id",
        "customermap_id",
    )


# --- OCP queue and tracking tables ----------------------------------------------------------


def queue_detail(df: DataFrame) -> DataFrame:
    return df.select(
        "emailqueueid",
        "messageguid",
        "redpointcontactid",
        "isautomatedseedlist",
        "istestsend",
        "emailqueuecreatedate",
        "privatelabelid",
        "shopperid",
        "sourcecode",
    )


def queue_success_templates(df: DataFrame) -> DataFrame:
    return df.select("emailqueueid", "templateid", "emailqueuecreatedate")


def queue_success_ids(df: DataFrame) -> DataFrame:
    return df.select("emailqueueid", "emailqueuesuccessid", "emailqueuecreatedate")


def click_tracking(df: DataFrame) -> DataFrame:
    return df.select(
        "trackingcode",
        F.col("emailqueuesuccesstrackingclickid").cast("string").alias("content_block_id"),
        F.col("createdate").alias("email_response_mst_ts"),
        F.col("visitguid").alias("content_block_click_visit_guid"),
        F.col("visitorguid").alias("content_block_click_visitor_guid"),
        F.col("eid").alias("content_block_click_eid_text"),
    )


def success_tracking(df: DataFrame) -> DataFrame:
    return df.select(
        "emailqueuesuccessid",
        "trackingcode",
        F.col("contentblockkeyid").cast("string").alias("content_block_key_id"),
        "emailqueuecreatedate",
    )


# --- Dimensions shared by the facts ---------------------------------------------------------


def templates(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("templateid").cast("string").alias("template_id"),
        F.col("templatename").alias("template_name"),
    )


def shoppers(df: DataFrame) -> DataFrame:
    return df.select("shopper_id", F.upper("country").alias("shopper_country_code"))


def block_keys(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("contentblockkeyid").cast("string").alias("content_block_key_id"),
        F.col("blockkeyname").alias("content_block_key_name"),
        F.col("contentblocksubcategoryid").cast("string").alias("content_block_subcategory_id"),
    )


def block_subcategories(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("contentblocksubcategoryid").cast("string").alias("content_block_subcategory_id"),
        F.col("blocksubcategoryname").alias("content_block_subcategory_name"),
        F.col("contentblockcategoryid").cast("string").alias("content_block_category_id"),
    )


def block_categories(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("contentblockcategoryid").cast("string").alias("content_block_category_id"),
        F.col("blockcategoryname").alias("content_block_category_name"),
    )


# --- SFMC tables ----------------------------------------------------------------------------


def sfmc_sent(df: DataFrame) -> DataFrame:
    return df.select(
        *SFMC_KEYS,
        "event_utc_ts",
        F.col("email_template_id").alias("template_id"),
        F.col("email_template_name").alias("email_name"),
        "year",
        "month",
    )


def sfmc_send_log(df: DataFrame) -> DataFrame:
    return df.select(
        *SFMC_KEYS,
        "event_utc_ts",
        "locale_code",
        "customer_id",
        F.col("internal_source_code").alias("isc_source_code"),
        F.col("cms_omni_campaign_id").alias("campaign_id"),
        F.col("cms_omni_segment_id").alias("segment_id"),
        F.col("cms_omni_channel_id").alias("channel_id"),
        "private_label_id",
        "year",
        "month",
    )


def customers(df: DataFrame) -> DataFrame:
    """Customer to shopper, one build of the table (see ``operators.builds``), repeats included."""
    return df.select(F.col("customerid").alias("customer_id"), F.col("id").alias("shopper_id"))


def exclusion_csv(spark: SparkSession, path: str) -> DataFrame:
    """The list of internal customers, a headed text file.

    The file may carry other columns in any order, so columns are found by header.
    """
    return spark.read.csv(path, header=True).select("QaCustomerID")


# --- Metadata tables ------------------------------------------------------------------------


def holdouts(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id",
        "etl_build_utc_ts",
        F.col("cms_omni_channel_id").alias("channel_id"),
        F.col("locale_code").alias("market_id"),
        F.col("internal_source_code").alias("isc_source_code"),
        "year",
        "month",
        "day",
    )


def template_versions(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("email_template_id").alias("email_id"),
        F.col("email_template_name").alias("email_name"),
        F.col("service_ticket_nr").alias("service_ticket_number"),
        "create_utc_ts",
    )
