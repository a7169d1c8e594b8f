"""Result schemas. Order matters: inserts are by position; partition columns come last.

Times are MST wall-clock values without a zone. Ids that are text in one email world and a
number in the other are text here.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def _table(columns: dict[str, str]) -> StructType:
    """A schema from names and Spark's type names; DDL text would need a running session."""
    out = StructType()
    for name, kind in columns.items():
        out = out.add(name, kind)
    return out


# Names, types and order of the columns of all result tables.
CLEAN_SENDS = _table(
    {
        "email_id": "long",
        "sent_mst_ts": "timestamp_ntz",
        "customermap_id": "long",
        "shopper_id": "string",
        "shopper_email_domain_name": "string",
        "privatelabel_id": "integer",
        "isc_code": "string",
        "emailsource_id": "integer",
        "emailsourcekey": "long",
        "template_id": "integer",
        "message_id": "string",
        "language_code": "string",
        "etl_build_mst_ts": "timestamp_ntz",
        "sent_mst_date": "string",
    }
)
CLEAN_SENDS_PARTITIONS = ["sent_mst_date"]

CLEAN_OPENS = _table(
    {
        "email_open_id": "long",
        "open_mst_ts": "timestamp_ntz",
        "customermap_id": "long",
        "shopper_id": "string",
        "shopper_email_domain_name": "string",
        "message_id": "string",
        "template_id": "integer",
        "privatelabel_id": "integer",
        "isc_code": "string",
        "language_code": "string",
        "etl_build_mst_ts": "timestamp_ntz",
        "open_mst_date": "string",
    }
)
CLEAN_OPENS_PARTITIONS = ["open_mst_date"]

QUEUE_STAGE = _table(
    {
        "messageguid": "string",
        "emailqueueid": "long",
        "templateid": "integer",
        "redpointcontactid": "long",
        "privatelabelid": "integer",
        "email_queue_shopper_id": "string",
        "email_queue_source_code": "string",
        "emailqueuecreatedate_ts": "timestamp_ntz",
        "email_queue_create_date": "string",
    }
)
QUEUE_STAGE_PARTITIONS = ["email_queue_create_date"]

SEND_FACT = _table(
    {
        "email_send_id": "string",
        "email_id": "string",
        "email_message_guid": "string",
        "email_send_mst_ts": "timestamp_ntz",
        "email_source_lead_id": "long",
        "email_source_key": "long",
        "template_id": "string",
        "template_name": "string",
        "email_holdout_flag": "boolean",
        "email_control_flag": "boolean",
        "email_sent_flag": "boolean",
        "email_language_code": "string",
        "email_country_code": "string",
        "private_label_id": "integer",
        "shopper_id": "string",
        "shopper_country_code": "string",
        "shopper_email_domain_name": "string",
        "isc_source_code": "string",
        "exclude_reason_desc": "string",
        "etl_build_mst_ts": "timestamp_ntz",
        "campaign_id": "integer",
        "segment_id": "integer",
        "channel_id": "integer",
        "email_name": "string",
        "email_send_mst_date": "string",
        "email_source_system_name": "string",
    }
)
SEND_FACT_PARTITIONS = ["email_send_mst_date", "email_source_system_name"]

RESPONSE_FACT = _table(
    {
        "email_send_id": "string",
        "email_id": "string",
        "email_message_guid": "string",
        "email_response_mst_ts": "timestamp_ntz",
        "email_send_mst_ts": "timestamp_ntz",
        "email_send_mst_date": "string",
        "email_response_type": "string",
        "email_response_code": "string",
        "content_block_id": "string",
        "content_block_key_id": "string",
        "content_block_key_name": "string",
        "content_block_category_id": "string",
        "content_block_category_name": "string",
        "content_block_subcategory_id": "string",
        "content_block_subcategory_name": "string",
        "content_block_click_eid_text": "string",
        "content_block_click_visit_guid": "string",
        "content_block_click_visitor_guid": "string",
        "first_open_flag": "boolean",
        "first_click_flag": "boolean",
        "first_complaint_flag": "boolean",
        "template_id": "string",
        "template_name": "string",
        "email_control_flag": "boolean",
        "email_language_code": "string",
        "email_country_code": "string",
        "private_label_id": "integer",
        "shopper_id": "string",
        "shopper_country_code": "string",
        "shopper_email_domain_name": "string",
        "isc_source_code": "string",
        "exclude_reason_desc": "string",
        "response_url_text": "string",
        "response_link_context_text": "string",
        "etl_build_mst_ts": "timestamp_ntz",
        "campaign_id": "integer",
        "segment_id": "integer",
        "channel_id": "integer",
        "email_name": "string",
        "response_link_name": "string",
        "email_response_mst_date": "string",
        "email_source_system_name": "string",
    }
)
RESPONSE_FACT_PARTITIONS = ["email_response_mst_date", "email_source_system_name"]

CONFORMED_EVENT = _table(
    {
        "sfmc_job_id": "long",
        "sfmc_list_id": "long",
        "sfmc_batch_id": "long",
        "sfmc_subscriber_id": "long",
        "email_response_type": "string",
        "email_response_code": "string",
        "first_open_flag": "boolean",
        "first_click_flag": "boolean",
        "first_complaint_flag": "boolean",
        "response_url_text": "string",
        "response_link_name": "string",
        "response_link_context_text": "string",
        "email_response_mst_ts": "timestamp_ntz",
    }
)

CAMPAIGN_DIM = _table(
    {
        "campaign_id": "integer",
        "segment_id": "integer",
        "channel_id": "integer",
        "campaign_channel_name": "string",
        "campaign_internal_source_code": "string",
        "campaign_optin_preference_desc": "string",
        "campaign_control_flag": "boolean",
        "campaign_test_flag": "boolean",
        "campaign_three_day_suppression_flag": "boolean",
        "campaign_test_type_desc": "string",
        "campaign_international_flag": "boolean",
        "campaign_product_desc": "string",
        "campaign_product_content_desc": "string",
        "campaign_revenue_generating_flag": "boolean",
        "campaign_objective_desc": "string",
        "campaign_subobjective_desc": "string",
        "campaign_category_name": "string",
        "campaign_subcategory_name": "string",
        "campaign_name": "string",
        "campaign_friendly_name": "string",
        "campaign_classification_desc": "string",
        "campaign_group_desc": "string",
        "segment_name": "string",
        "campaign_message_classification": "string",
        "campaign_trigger_type_desc": "string",
        "campaign_gho_filter_applied_flag": "boolean",
        "etl_build_mst_ts": "timestamp_ntz",
        "etl_build_mst_date": "string",
    }
)
CAMPAIGN_DIM_PARTITIONS = ["etl_build_mst_date"]

TEMPLATE_DIM = _table(
    {
        "email_id": "string",
        "email_name": "string",
        "service_ticket_number": "string",
        "create_mst_ts": "timestamp_ntz",
        "etl_build_mst_ts": "timestamp_ntz",
        "etl_build_mst_date": "string",
    }
)
TEMPLATE_DIM_PARTITIONS = ["etl_build_mst_date"]

HOLDOUT_DIM = _table(
    {
        "customer_id": "string",
        "campaign_selection_mst_ts": "timestamp_ntz",
        "channel_id": "integer",
        "shopper_id": "string",
        "market_id": "string",
        "isc_source_code": "string",
        "etl_build_mst_ts": "timestamp_ntz",
        "snap_date": "string",
    }
)
HOLDOUT_DIM_PARTITIONS = ["snap_date"]
