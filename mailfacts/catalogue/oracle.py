"""The catalogue's SQL, for an engine that has the test tables as views."""

from __future__ import annotations

import re

from mailfacts.catalogue.fixtures import BUILDS, OLDER_SNAPSHOT, SNAPSHOT
from mailfacts.catalogue.parameters import (
    BUILD_TS,
    END_DAY,
    EVENTS_END_DAY,
    EVENTS_FIRST_DAY,
    FIRST_DAY,
    LOOKUP_FROM,
    LOOKUP_TO,
    MOVED_DAYS,
    MOVED_FROM,
    MOVED_TO,
    PRUNE_FROM,
    PRUNE_TO,
    REFLAG_FROM,
    RESPONSES_END_DAY,
    SHIFT_FROM,
    SHIFT_TO,
    WHOLE,
    WINDOW,
    WINDOW_END_TS,
    WINDOW_FIRST_TS,
    WINDOW_RUN_END_TS,
)

BUILD = f"CAST('{BUILD_TS}' AS TIMESTAMP)"
SFMC_KEYS = "sfmc_job_id, sfmc_list_id, sfmc_batch_id, sfmc_subscriber_id"
NULL_TEXT, NULL_INT, NULL_FLAG = (f"CAST(NULL AS {t})" for t in ("VARCHAR", "INTEGER", "BOOLEAN"))


def _locale(number: str) -> str:
    return f"CASE {number} % 3 WHEN 0 THEN 'en-US' WHEN 1 THEN 'fr' ELSE 'pt-BR' END"


def _sentinel(column: str) -> str:
    return f"CASE WHEN length({column}) > 0 THEN {column} ELSE 'NULL' END"


def _norm(column: str) -> str:
    return f"trim(lower(CAST({column} AS VARCHAR)))"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _mst(column: str) -> str:
    return f"({column} - INTERVAL 7 HOUR)"


def _mst_between(column: str, lo: str, hi: str) -> str:
    return f"{_mst(column)} BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}'"


def _source_system(mass_mailer: str) -> str:
    return (
        f"CASE WHEN source_id = 8 THEN '{mass_mailer}' WHEN source_id = 9999 THEN 'redpoint'"
        " ELSE 'ocp' END"
    )


ISC = "CASE WHEN o_totalprice < 50000 THEN '' ELSE o_orderpriority END"
SHOPPER = "CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END"
SOURCE = (
    "CASE o_orderpriority WHEN '2-HIGH' THEN 8 WHEN '3-MEDIUM' THEN 13 WHEN '5-LOW' THEN 99"
    " ELSE 7 END"
)
TRACKING = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
NOTED_LATE = "to_days(CAST(greatest(o_orderkey % 10 - 4, 0) AS INTEGER))"
REDPOINT = "coalesce(redpointcontactid, 0) <> 0"


def _lines(flag: str) -> str:
    return (
        "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
        f" WHERE l_returnflag = '{flag}'"
    )


def _sfmc_event(kind: str, extra: str) -> str:
    return f"""
        SELECT CAST(day(ts) AS BIGINT) AS sfmc_job_id, user_id % 3 AS sfmc_list_id,
            CAST(hour(ts) // 12 AS BIGINT) AS sfmc_batch_id, user_id AS sfmc_subscriber_id,
            ts AS event_utc_ts, event_id, value, props{extra}
        FROM events WHERE event_type = '{kind}'"""


# Definitions shared by the queries, each only using earlier ones. ``_with`` adds those a
# statement mentions. ``d`` has the ranges of an OCP run, ``e`` the ends of an SFMC run.
def _definitions(d: dict[str, str], e: tuple[str, str, str]) -> dict[str, str]:
    events_first, responses_end, run_end = e
    return {
    # Sources.
    "src_customermap": f"""
        SELECT c_custkey AS customermap_id, {SHOPPER} AS shopperid,
            CASE WHEN c_mktsegment <> 'FURNITURE' THEN lower(c_mktsegment) || '.example' END
                AS emaildomain
        FROM customer""",
    "lines_n": _lines("N"),
    "lines_a": _lines("A"),
    "lines_r": _lines("R"),
    "src_contact_email": f"""
        SELECT o_custkey AS customermap_id, CAST(o_orderkey % 200 AS INTEGER) AS template_id,
            {SOURCE} AS emailsource_id, {_locale('o_orderkey')} AS lang, {ISC} AS isccode,
            CAST(o_orderkey % 5 AS INTEGER) AS privatelabel_id, o_orderkey AS email_id,
            'M' || o_orderkey AS message_id, o_orderdate AS sentdate,
            o_orderkey % 1000 AS emailsourcekey
        FROM orders
        UNION ALL
        SELECT o_custkey, CAST(o_orderkey % 200 AS INTEGER), {SOURCE}, {_locale('o_orderkey')},
            {ISC}, CAST(o_orderkey % 5 AS INTEGER),
            1000000000 + l_orderkey * 8 + l_linenumber,
            CASE WHEN l_linestatus = 'O' THEN 'M' ELSE ' m' END || l_orderkey, l_shipdate,
            l_partkey % 1000
        FROM lines_n""",
    "src_opens": f"""
        SELECT l_orderkey * 8 + l_linenumber AS email_open_id, ' m' || l_orderkey AS message_id,
            lower({ISC}) AS isccode, CAST(l_orderkey % 200 AS INTEGER) AS template_id,
            l_shipdate AS opendate, {_locale('l_orderkey')} AS lang,
            CAST(l_orderkey % 5 AS INTEGER) AS privatelabel_id, o_custkey AS customermap_id
        FROM lines_a""",
    "queued": """
        SELECT *, 0 AS turn, o_orderkey AS queue_id, o_orderdate AS queued_at FROM orders
        UNION ALL
        SELECT *, 1, o_orderkey + 2000000000, o_orderdate + INTERVAL 1 DAY FROM orders
        WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'""",
    "src_queue_detail": f"""
        SELECT queue_id AS emailqueueid, 'M' || o_orderkey AS messageguid,
            CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN o_custkey + turn END
                AS redpointcontactid,
            CAST(o_totalprice < 10000 AS INTEGER) AS isautomatedseedlist,
            CAST(o_totalprice > 490000 AS INTEGER) AS istestsend,
            queued_at AS emailqueuecreatedate,
            CAST(o_orderkey % 5 AS INTEGER) AS privatelabelid, {SHOPPER} AS shopperid,
            o_orderstatus AS sourcecode
        FROM queued JOIN customer ON o_custkey = c_custkey""",
    "src_queue_success": f"""
        SELECT queue_id AS emailqueueid, queue_id + 1000000000 AS emailqueuesuccessid,
            CAST(o_orderkey % 200 AS INTEGER) AS templateid,
            queued_at + {NOTED_LATE} AS emailqueuecreatedate
        FROM queued WHERE o_totalprice >= 20000""",
    "src_tracking": f"""
        SELECT DISTINCT l_orderkey + 1000000000 AS emailqueuesuccessid,
            {TRACKING} AS trackingcode, CAST(l_suppkey AS VARCHAR) AS content_block_key_id,
            o_orderdate + {NOTED_LATE} AS emailqueuecreatedate
        FROM lines_r""",
    "src_clicks": f"""
        SELECT {TRACKING} AS trackingcode, 'k' || {TRACKING} AS content_block_id,
            l_shipdate AS createdate, 'v' || l_partkey AS visit, 'w' || l_suppkey AS visitor,
            CASE WHEN l_linenumber = 1 THEN 'other.' ELSE 'ocp.email.' END || l_linenumber AS eid
        FROM lineitem WHERE l_returnflag = 'R'""",
    "src_template": """
        SELECT CAST(p_partkey AS VARCHAR) AS tpl_id, p_name AS template_name FROM part""",
    "content": """
        SELECT CAST(s_suppkey AS VARCHAR) AS key_id, s_name AS key_name,
            CAST(s_nationkey AS VARCHAR) AS subcategory_id, n_name AS subcategory_name,
            CAST(n_regionkey AS VARCHAR) AS category_id, r_name AS category_name
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
            LEFT JOIN region ON n_regionkey = r_regionkey""",
    "src_shopper": """
        SELECT c_name AS dim_shopper, upper(lower(n_name)) AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_mailings": f"""
        SELECT {SFMC_KEYS}, min(event_utc_ts) AS event_utc_ts, min(event_id) AS event_id,
            max(value) AS value
        FROM ({_sfmc_event('purchase', '')}) GROUP BY ALL""",
    "src_exclusion": """
        SELECT CAST(c_custkey AS VARCHAR) AS listed_id FROM customer WHERE c_acctbal < 2000
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0""",
    "src_customer_ids": f"""
        SELECT CASE WHEN build_ts = '{BUILDS[0]}' THEN 'old ' ELSE '' END || c_name AS id,
            CAST(c_custkey AS VARCHAR) AS customerid, build_ts
        FROM customer, (VALUES ('{BUILDS[0]}'), ('{BUILDS[1]}')) AS builds(build_ts)""",
    "responses": """
        SELECT 's' || user_id AS email_send_id, CAST(event_id AS VARCHAR) AS email_id,
            event_type AS email_response_type,
            CASE event_type WHEN 'view' THEN 'o' WHEN 'click' THEN 'c' WHEN 'signup' THEN 's'
                WHEN 'error' THEN 'hb' END AS email_response_code,
            ts AS email_response_mst_ts, strftime(ts, '%Y-%m-%d') AS email_response_mst_date,
            CASE WHEN value >= 200 THEN 'sfmc' WHEN value >= 1 THEN 'ocp' END
                AS email_source_system_name
        FROM events""",
    # Clean layer and stage.
    "clean_sends": f"""
        SELECT DISTINCT email_id, sentdate AS sent_mst_ts, customermap_id,
            {_sentinel('shopperid')} AS shopper_id,
            {_sentinel('emaildomain')} AS shopper_email_domain_name, privatelabel_id,
            {_sentinel('isccode')} AS isc_code, emailsource_id, emailsourcekey, template_id,
            message_id, lang AS language_code, {BUILD} AS etl_build_mst_ts,
            {_day('sentdate')} AS sent_mst_date
        FROM src_contact_email JOIN src_customermap USING (customermap_id)
        WHERE sentdate BETWEEN TIMESTAMP '{FIRST_DAY}' AND TIMESTAMP '{END_DAY}'
            AND emailsource_id IN (7, 8, 13)""",
    "clean_opens": f"""
        SELECT DISTINCT email_open_id, opendate AS open_mst_ts, customermap_id,
            {_sentinel('shopperid')} AS shopper_id,
            {_sentinel('emaildomain')} AS shopper_email_domain_name, message_id, template_id,
            privatelabel_id, {_sentinel('isccode')} AS isc_code, lang AS language_code,
            {BUILD} AS etl_build_mst_ts, {_day('opendate')} AS open_mst_date
        FROM src_opens JOIN src_customermap USING (customermap_id)
        WHERE opendate BETWEEN TIMESTAMP '{FIRST_DAY}' AND TIMESTAMP '{END_DAY}'""",
    "queued_rows": """
        SELECT messageguid, templateid, redpointcontactid,
            d.emailqueuecreatedate AS queued_ts, s.emailqueuecreatedate AS succeeded_ts
        FROM src_queue_detail d JOIN src_queue_success s ON d.emailqueueid = s.emailqueueid
        WHERE isautomatedseedlist = 0 AND istestsend = 0""",
    "queue_stage": f"""
        SELECT messageguid, d.emailqueueid, templateid, redpointcontactid, privatelabelid,
            shopperid AS email_queue_shopper_id, sourcecode AS email_queue_source_code,
            d.emailqueuecreatedate AS emailqueuecreatedate_ts,
            {_day('d.emailqueuecreatedate')} AS email_queue_create_date
        FROM src_queue_detail d JOIN src_queue_success s ON d.emailqueueid = s.emailqueueid
        WHERE isautomatedseedlist = 0 AND istestsend = 0
            AND d.emailqueuecreatedate BETWEEN TIMESTAMP '{FIRST_DAY}' AND TIMESTAMP '{END_DAY}'
            AND s.emailqueuecreatedate BETWEEN TIMESTAMP '{FIRST_DAY}' AND TIMESTAMP '{END_DAY}'
        """,
    # Attribution.
    "latest_sends": f"""
        SELECT *, {_norm('shopper_id')} AS k_shopper, {_norm('message_id')} AS k_message,
            {_norm('isc_code')} AS k_isc, {_norm('template_id')} AS k_template
        FROM clean_sends
        WHERE sent_mst_date >= '{d["send_start"]}' AND sent_mst_date < '{d["end"]}'
        QUALIFY row_number() OVER (
            PARTITION BY k_shopper, k_message, k_isc, k_template
            ORDER BY sent_mst_ts DESC NULLS LAST, email_id DESC NULLS LAST,
                customermap_id DESC, emailsourcekey DESC, emailsource_id DESC) = 1""",
    "open_sends": f"""
        SELECT o.*, s.email_id, s.sent_mst_ts, s.emailsourcekey, s.emailsource_id,
            s.customermap_id AS sent_customermap_id,
            s.shopper_email_domain_name AS sent_domain
        FROM clean_opens o LEFT JOIN latest_sends s
            ON {_norm('o.shopper_id')} = k_shopper AND {_norm('o.message_id')} = k_message
            AND {_norm('o.isc_code')} = k_isc AND {_norm('o.template_id')} = k_template
        WHERE open_mst_date >= '{d["open_start"]}' AND open_mst_date < '{d["open_end"]}'""",
    "run_stage": f"""
        SELECT * FROM queue_stage
        WHERE email_queue_create_date BETWEEN '{d["send_start"]}' AND '{d["end"]}'""",
    "stage_distinct": """
        SELECT messageguid, templateid, redpointcontactid FROM run_stage GROUP BY 1, 2, 3""",
    "open_queue": f"""
        SELECT o.*, redpointcontactid
        FROM open_sends o LEFT JOIN stage_distinct
            ON {_norm('message_id')} = {_norm('messageguid')}
            AND {_norm('template_id')} = {_norm('templateid')}""",
    "latest_stage": f"""
        SELECT * FROM run_stage
        WHERE email_queue_create_date BETWEEN '{d["click_queue_start"]}' AND '{d["end"]}'
        QUALIFY row_number() OVER (PARTITION BY messageguid, templateid
            ORDER BY email_queue_create_date DESC NULLS LAST, emailqueueid DESC NULLS LAST) = 1
        """,
    "click_sends": f"""
        SELECT *, {_norm('shopper_id')} AS k_shopper, {_norm('message_id')} AS k_message,
            {_norm('isc_code')} AS k_isc, {_norm('template_id')} AS k_template
        FROM clean_sends
        WHERE sent_mst_date >= '{d["send_start"]}' AND sent_mst_date < '{d["end"]}'
            AND sent_mst_ts BETWEEN TIMESTAMP '{d["click_queue_start"]}'
                AND TIMESTAMP '{d["end"]}'
        QUALIFY row_number() OVER (
            PARTITION BY k_shopper, k_message, k_isc, k_template
            ORDER BY sent_mst_ts DESC NULLS LAST, email_id DESC NULLS LAST,
                customermap_id DESC, emailsourcekey DESC, emailsource_id DESC) = 1""",
    "click_chain": f"""
        SELECT q.redpointcontactid, s.customermap_id, s.email_id, s.sent_mst_ts,
            s.emailsourcekey, s.emailsource_id, s.shopper_email_domain_name, s.message_id,
            s.template_id, s.shopper_id, s.language_code, s.isc_code, s.privatelabel_id,
            c.createdate AS email_response_mst_ts,
            {_day('c.createdate')} AS email_response_mst_date, 'c' AS email_response_code,
            'click' AS email_response_type, c.content_block_id,
            c.visit AS content_block_click_visit_guid,
            c.visitor AS content_block_click_visitor_guid,
            c.eid AS content_block_click_eid_text, t.content_block_key_id
        FROM src_clicks c JOIN src_tracking t ON c.trackingcode = t.trackingcode
            JOIN src_queue_success u ON t.emailqueuesuccessid = u.emailqueuesuccessid
            JOIN latest_stage q ON u.emailqueueid = q.emailqueueid
            JOIN click_sends s ON {_norm('q.email_queue_shopper_id')} = k_shopper
                AND {_norm('q.messageguid')} = k_message
                AND {_norm('q.templateid')} = k_template
        WHERE starts_with(c.eid, 'ocp.email.')
            AND c.createdate BETWEEN TIMESTAMP '{d["open_start"]}' AND TIMESTAMP '{d["open_end"]}'
            AND t.emailqueuecreatedate BETWEEN TIMESTAMP '{d["queue_start"]}'
                AND TIMESTAMP '{d["end"]}'
            AND u.emailqueuecreatedate BETWEEN TIMESTAMP '{d["queue_start"]}'
                AND TIMESTAMP '{d["end"]}'""",
    "response_union": f"""
        SELECT redpointcontactid, sent_customermap_id AS customermap_id, email_id, sent_mst_ts,
            emailsourcekey, emailsource_id, sent_domain AS shopper_email_domain_name,
            message_id, template_id, shopper_id, language_code, isc_code, privatelabel_id,
            open_mst_ts AS email_response_mst_ts, open_mst_date AS email_response_mst_date,
            'o' AS email_response_code, 'open' AS email_response_type,
            {NULL_TEXT} AS content_block_id, {NULL_TEXT} AS content_block_click_visit_guid,
            {NULL_TEXT} AS content_block_click_visitor_guid,
            {NULL_TEXT} AS content_block_click_eid_text, {NULL_TEXT} AS content_block_key_id
        FROM open_queue
        UNION ALL BY NAME
        SELECT * FROM click_chain""",
    "response_keyed": f"""
        SELECT *, CASE WHEN {REDPOINT} THEN 9999 ELSE emailsource_id END AS source_id,
            lower(isc_code) AS isc_source_code,
            sha256(concat_ws('|', message_id, shopper_id, lower(isc_code), template_id))
                AS email_send_id
        FROM response_union""",
    "response_fact_ocp": f"""
        SELECT DISTINCT email_send_id, CAST(email_id AS VARCHAR) AS email_id,
            message_id AS email_message_guid, email_response_mst_ts,
            sent_mst_ts AS email_send_mst_ts, {_day('sent_mst_ts')} AS email_send_mst_date,
            email_response_type, email_response_code, content_block_id, content_block_key_id,
            key_name AS content_block_key_name, category_id AS content_block_category_id,
            category_name AS content_block_category_name,
            subcategory_id AS content_block_subcategory_id,
            subcategory_name AS content_block_subcategory_name, content_block_click_eid_text,
            content_block_click_visit_guid, content_block_click_visitor_guid,
            {NULL_FLAG} AS first_open_flag, {NULL_FLAG} AS first_click_flag,
            {NULL_FLAG} AS first_complaint_flag, CAST(template_id AS VARCHAR) AS template_id,
            template_name, FALSE AS email_control_flag,
            string_split(language_code, '-')[1] AS email_language_code,
            string_split(language_code, '-')[2] AS email_country_code,
            privatelabel_id AS private_label_id, shopper_id, country AS shopper_country_code,
            shopper_email_domain_name, isc_source_code, {NULL_TEXT} AS exclude_reason_desc,
            {NULL_TEXT} AS response_url_text,
            content_block_click_eid_text AS response_link_context_text,
            {BUILD} AS etl_build_mst_ts, {NULL_INT} AS campaign_id, {NULL_INT} AS segment_id,
            {NULL_INT} AS channel_id, {NULL_TEXT} AS email_name,
            key_name AS response_link_name, email_response_mst_date,
            {_source_system('massmailer')} AS email_source_system_name
        FROM response_keyed LEFT JOIN src_template ON CAST(template_id AS VARCHAR) = tpl_id
            LEFT JOIN content ON content_block_key_id = key_id
            LEFT JOIN src_shopper ON shopper_id = dim_shopper""",
    # SFMC.
    "sfmc_sent": f"""
        SELECT {SFMC_KEYS}, CAST(event_id AS VARCHAR) AS template_id,
            'mail ' || event_id AS email_name, {_mst('event_utc_ts')} AS email_send_mst_ts
        FROM src_mailings
        WHERE {_mst_between('event_utc_ts', EVENTS_FIRST_DAY, EVENTS_END_DAY)}""",
    "sfmc_log": f"""
        SELECT {SFMC_KEYS}, {_locale('event_id')} AS locale_code,
            CAST(sfmc_subscriber_id AS VARCHAR) AS customer_id,
            'isc' || sfmc_subscriber_id % 7 AS isc_source_code,
            CAST(sfmc_subscriber_id % 50 AS INTEGER) AS campaign_id,
            CAST(sfmc_subscriber_id % 20 AS INTEGER) AS segment_id,
            CAST(sfmc_subscriber_id % 10 AS INTEGER) AS channel_id,
            CAST(sfmc_subscriber_id % 5 AS INTEGER) AS private_label_id
        FROM src_mailings WHERE value >= 5
            AND {_mst_between('event_utc_ts', EVENTS_FIRST_DAY, EVENTS_END_DAY)}""",
    "sfmc_logged": f"SELECT * FROM sfmc_sent LEFT JOIN sfmc_log USING ({SFMC_KEYS})",
    "bounces": f"""
        SELECT *, CASE WHEN value < 10 THEN 'Soft bounce' WHEN value < 30 THEN 'Hard Bounce'
            WHEN value < 60 THEN 'Technical/Other bounce' ELSE 'Unknown' END AS bounce_category
        FROM ({_sfmc_event('error', '')})""",
    "bounce_codes": """
        SELECT *, lower(bounce_category) AS email_response_type,
            substr(string_split(lower(bounce_category), ' ')[1], 1, 1)
                || substr(string_split(lower(bounce_category), ' ')[2], 1, 1)
                AS email_response_code
        FROM bounces""",
    "sfmc_events": f"""
        SELECT * EXCLUDE (event_utc_ts, window_end),
            {_mst('event_utc_ts')} AS email_response_mst_ts
        FROM (
            SELECT {SFMC_KEYS}, 'open' AS email_response_type, 'o' AS email_response_code,
                value >= 50 AS first_open_flag, {NULL_FLAG} AS first_click_flag,
                {NULL_FLAG} AS first_complaint_flag, {NULL_TEXT} AS response_url_text,
                {NULL_TEXT} AS response_link_name, {NULL_TEXT} AS response_link_context_text,
                event_utc_ts, '{responses_end}' AS window_end
            FROM ({_sfmc_event('view', '')})
            UNION ALL
            SELECT {SFMC_KEYS}, email_response_type, email_response_code, NULL, NULL, NULL,
                NULL, NULL, NULL, event_utc_ts, '{run_end}'
            FROM bounce_codes
            UNION ALL
            SELECT {SFMC_KEYS}, 'click', 'c', NULL, value >= 50, NULL,
                'https://shop.example/' || event_id, 'link ' || event_id, props, event_utc_ts,
                '{responses_end}'
            FROM ({_sfmc_event('click', '')})
            UNION ALL
            SELECT {SFMC_KEYS}, CASE WHEN value < 10 THEN 'spam' ELSE 'unsubscribe' END,
                CASE WHEN value < 10 THEN 's' ELSE 'u' END, NULL, NULL, NULL, NULL, NULL, NULL,
                event_utc_ts, '{responses_end}'
            FROM ({_sfmc_event('signup', '')}))
        WHERE {_mst('event_utc_ts')} >= TIMESTAMP '{events_first}'
            AND {_mst('event_utc_ts')} <= CAST(window_end AS TIMESTAMP)""",
    "exclusion": "SELECT DISTINCT listed_id FROM src_exclusion",
    "build": """
        SELECT DISTINCT customerid, id FROM src_customer_ids
        WHERE build_ts = (SELECT max(build_ts) FROM src_customer_ids)""",
    }


_SFMC_COLUMNS = f"""
    sha256(concat_ws('|', {SFMC_KEYS})) AS email_send_id, {NULL_TEXT} AS email_id,
    {NULL_TEXT} AS email_message_guid, email_send_mst_ts, template_id,
    {NULL_TEXT} AS template_name, {NULL_FLAG} AS email_control_flag,
    string_split(locale_code, '-')[1] AS email_language_code,
    string_split(locale_code, '-')[2] AS email_country_code, private_label_id,
    id AS shopper_id, country AS shopper_country_code, {NULL_TEXT} AS shopper_email_domain_name,
    isc_source_code, CASE WHEN listed_id IS NOT NULL THEN 'internal customer' END
        AS exclude_reason_desc,
    {BUILD} AS etl_build_mst_ts, campaign_id, segment_id, channel_id, email_name,
    {_day('email_send_mst_ts')} AS email_send_mst_date, 'sfmc' AS email_source_system_name"""
_SFMC_DIMENSIONS = """
    LEFT JOIN exclusion ON customer_id = listed_id
    LEFT JOIN build ON customer_id = customerid
    LEFT JOIN src_shopper ON id = dim_shopper"""


def _flags(rows: str, names: str, start: str, all_start: str, end: str) -> str:
    """The flags as one window, unlike either Spark form."""
    late = (
        "coalesce(email_send_id IS NOT NULL AND email_response_type IS NOT NULL"
        " AND email_response_mst_ts > min(CASE WHEN email_response_mst_date"
        f" BETWEEN '{all_start}' AND '{end}' THEN email_response_mst_ts END)"
        " OVER (PARTITION BY email_send_id, email_response_type), FALSE)"
    )
    return f"""
        SELECT DISTINCT {names},
            coalesce(email_response_code = 'o', FALSE) AND NOT late AS first_open_flag,
            coalesce(email_response_code = 'c', FALSE) AND NOT late AS first_click_flag,
            coalesce(email_response_code = 's', FALSE) AND NOT late AS first_complaint_flag
        FROM (SELECT *, {late} AS late FROM {rows} WHERE email_source_system_name <> 'sfmc')
        WHERE email_response_mst_date BETWEEN '{start}' AND '{end}'"""


def _event_flags(start: str) -> str:
    names = (
        "email_send_id, email_id, email_response_type, email_response_code,"
        " email_response_mst_ts, email_response_mst_date, email_source_system_name"
    )
    return _flags("responses", names, start, EVENTS_FIRST_DAY, EVENTS_END_DAY)


_LINE_RESPONSES = """(
    SELECT CAST(l_orderkey AS VARCHAR) AS email_send_id, l_returnflag AS email_response_type,
        CASE l_returnflag WHEN 'A' THEN 'o' WHEN 'R' THEN 'c' ELSE 's' END
            AS email_response_code,
        l_shipdate AS email_response_mst_ts,
        strftime(l_shipdate, '%Y-%m-%d') AS email_response_mst_date,
        'ocp' AS email_source_system_name, l_partkey, l_linenumber, l_suppkey
    FROM lineitem)"""

_SPLIT = f"""
    SELECT email_id, source_id AS emailsource_id, redpointcontactid, channel_name,
        {_source_system('mass mailer')} AS email_source_system_name,
        source_id = 13 AS email_holdout_flag,
        coalesce(channel_name LIKE '%control%', FALSE) AS email_control_flag,
        source_id <> 13 AS email_sent_flag
    FROM (
        SELECT e.email_id, redpointcontactid,
            CASE WHEN {REDPOINT} THEN 9999 ELSE emailsource_id END AS source_id,
            CASE isccode WHEN '1-URGENT' THEN 'a control group' WHEN '2-HIGH' THEN 'mail' END
                AS channel_name
        FROM src_contact_email e LEFT JOIN src_queue_detail d ON e.email_id = d.emailqueueid)"""

def _send_fact(d: dict[str, str]) -> str:
    return f"""
        SELECT DISTINCT sha256(concat_ws('|', message_id, shopper_id, lower(isc_code),
                template_id)) AS email_send_id,
            CAST(email_id AS VARCHAR) AS email_id, message_id AS email_message_guid,
            sent_mst_ts AS email_send_mst_ts, redpointcontactid AS email_source_lead_id,
            emailsourcekey AS email_source_key, CAST(template_id AS VARCHAR) AS template_id,
            template_name, source_id = 13 AS email_holdout_flag, FALSE AS email_control_flag,
            source_id <> 13 AS email_sent_flag,
            string_split(language_code, '-')[1] AS email_language_code,
            string_split(language_code, '-')[2] AS email_country_code,
            privatelabel_id AS private_label_id, shopper_id, country AS shopper_country_code,
            shopper_email_domain_name, lower(isc_code) AS isc_source_code,
            {NULL_TEXT} AS exclude_reason_desc, etl_build_mst_ts, {NULL_INT} AS campaign_id,
            {NULL_INT} AS segment_id, {NULL_INT} AS channel_id, {NULL_TEXT} AS email_name,
            sent_mst_date AS email_send_mst_date,
            {_source_system('mass mailer')} AS email_source_system_name
        FROM (
            SELECT s.*, redpointcontactid,
                CASE WHEN {REDPOINT} THEN 9999 ELSE emailsource_id END AS source_id
            FROM clean_sends s
                JOIN queued_rows ON message_id = messageguid AND template_id = templateid
            WHERE sent_mst_date >= '{d["send_start"]}' AND sent_mst_date < '{d["end"]}'
                AND queued_ts BETWEEN TIMESTAMP '{d["queue_start"]}' AND TIMESTAMP '{d["end"]}'
                AND succeeded_ts BETWEEN TIMESTAMP '{d["queue_start"]}'
                    AND TIMESTAMP '{d["end"]}')
            LEFT JOIN src_template ON CAST(template_id AS VARCHAR) = tpl_id
            LEFT JOIN src_shopper ON shopper_id = dim_shopper"""


STATEMENTS = {
    "first_response_flags": _event_flags(EVENTS_FIRST_DAY),
    "first_response_flags_incremental": _event_flags(REFLAG_FROM),
    "first_response_flags_join": _event_flags(REFLAG_FROM),
    "first_response_ties": _flags(
        _LINE_RESPONSES,
        "email_send_id, email_response_type, email_response_code, email_response_mst_ts,"
        " email_response_mst_date, email_source_system_name, l_partkey, l_linenumber, l_suppkey",
        FIRST_DAY,
        FIRST_DAY,
        END_DAY,
    ),
    "clean_sends": "SELECT * FROM clean_sends",
    "clean_opens": "SELECT * FROM clean_opens",
    "queue_stage": "SELECT * FROM queue_stage",
    "stage_distinct": "SELECT * FROM stage_distinct",
    "stage_dedupe_keyed": """
        SELECT l_orderkey, l_returnflag, l_shipdate, l_linenumber, l_partkey, l_suppkey
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag
            ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC NULLS LAST,
                l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) = 1""",
    "send_dedupe_latest": """
        SELECT shopper_id, message_id, isc_code, template_id, email_id, sent_mst_ts
        FROM latest_sends""",
    "parameterised_sql": f"""
        SELECT messageguid, templateid, redpointcontactid FROM queue_stage
        WHERE email_queue_create_date BETWEEN '{PRUNE_FROM}' AND '{PRUNE_TO}'
        GROUP BY 1, 2, 3""",
    "email_key": """
        SELECT email_id, message_id, sha256(concat_ws('|', message_id, customermap_id,
            lower(nullif(isccode, '')), template_id)) AS email_send_id
        FROM src_contact_email""",
    "locale_parts": """
        SELECT email_id, string_split(lang, '-')[1] AS email_language_code,
            string_split(lang, '-')[2] AS email_country_code
        FROM src_contact_email""",
    "bounce_code": "SELECT event_id, email_response_type, email_response_code FROM bounce_codes",
    "mst_dates": f"""
        SELECT event_id, {_mst('ts')} AS mst_ts, {_day(_mst('ts'))} AS mst_date FROM events""",
    "mst_bound_pushdown": f"""
        SELECT event_id, {_mst('ts')} AS mst_ts FROM events
        WHERE {_mst_between('ts', SHIFT_FROM, SHIFT_TO)}""",
    "year_month_prune": f"""
        SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= date_trunc('month', TIMESTAMP '{PRUNE_FROM}')""",
    "shopper_country": """
        SELECT email_id, shopper_id, country AS shopper_country_code
        FROM clean_sends LEFT JOIN src_shopper ON shopper_id = dim_shopper""",
    "channel_split": _SPLIT,
    "channel_split_union": _SPLIT,
    "send_fact_ocp": _send_fact(WHOLE),
    "send_fact_ocp_window": _send_fact(WINDOW),
    "norm_join_open_send": """
        SELECT email_open_id, open_mst_ts, shopper_id, message_id, email_id, sent_mst_ts,
            emailsource_id, sent_domain AS shopper_email_domain_name
        FROM open_sends""",
    "open_queue_fanout": """
        SELECT email_open_id, open_mst_ts, message_id, redpointcontactid FROM open_queue""",
    "click_chain": "SELECT * FROM click_chain",
    "response_union": "SELECT * FROM response_union",
    "content_hierarchy": """
        SELECT trackingcode, content_block_key_id, key_name AS content_block_key_name,
            subcategory_id AS content_block_subcategory_id,
            subcategory_name AS content_block_subcategory_name,
            category_id AS content_block_category_id,
            category_name AS content_block_category_name
        FROM src_tracking LEFT JOIN content ON content_block_key_id = key_id""",
    "response_fact_ocp": "SELECT * FROM response_fact_ocp",
    "flagged_response_fact_ocp": _flags(
        "response_fact_ocp",
        "* EXCLUDE (late, first_open_flag, first_click_flag, first_complaint_flag)",
        FIRST_DAY,
        FIRST_DAY,
        END_DAY,
    ),
    "response_fact_ocp_window": "SELECT * FROM response_fact_ocp",
    "conform_events": "SELECT * FROM sfmc_events",
    "conform_events_window": "SELECT * FROM sfmc_events",
    "sfmc_send_prune": f"""
        SELECT {SFMC_KEYS}, CAST(event_id AS VARCHAR) AS template_id,
            'mail ' || event_id AS email_name,
            {_mst(f"event_utc_ts + INTERVAL {MOVED_DAYS} DAY")} AS email_send_mst_ts
        FROM src_mailings
        WHERE {_mst_between(f"event_utc_ts + INTERVAL {MOVED_DAYS} DAY", MOVED_FROM, MOVED_TO)}""",
    "sfmc_send_log_join": "SELECT * FROM sfmc_logged",
    "exclusion_flag": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_id,
            CASE WHEN listed_id IS NOT NULL THEN 'internal customer' END AS exclude_reason_desc
        FROM orders LEFT JOIN exclusion ON CAST(o_custkey AS VARCHAR) = listed_id""",
    "latest_build": "SELECT customerid AS customer_id, id AS shopper_id FROM build",
    "send_fact_sfmc": f"""
        SELECT DISTINCT {_SFMC_COLUMNS}, CAST(NULL AS BIGINT) AS email_source_lead_id,
            CAST(NULL AS BIGINT) AS email_source_key, {NULL_FLAG} AS email_holdout_flag,
            TRUE AS email_sent_flag
        FROM sfmc_logged {_SFMC_DIMENSIONS}""",
    "response_fact_sfmc": f"""
        SELECT {_SFMC_COLUMNS}, email_response_mst_ts,
            {_day('email_response_mst_ts')} AS email_response_mst_date, email_response_type,
            email_response_code, first_open_flag, first_click_flag, first_complaint_flag,
            response_url_text, response_link_name, response_link_context_text,
            {NULL_TEXT} AS content_block_id, {NULL_TEXT} AS content_block_key_id,
            {NULL_TEXT} AS content_block_key_name, {NULL_TEXT} AS content_block_category_id,
            {NULL_TEXT} AS content_block_category_name,
            {NULL_TEXT} AS content_block_subcategory_id,
            {NULL_TEXT} AS content_block_subcategory_name,
            {NULL_TEXT} AS content_block_click_eid_text,
            {NULL_TEXT} AS content_block_click_visit_guid,
            {NULL_TEXT} AS content_block_click_visitor_guid
        FROM sfmc_events LEFT JOIN sfmc_logged USING ({SFMC_KEYS}) {_SFMC_DIMENSIONS}""",
    "dim_campaign": f"""
        SELECT DISTINCT n_regionkey AS campaign_id, s_nationkey AS segment_id,
            CAST(s_suppkey AS INTEGER) AS channel_id, s_name AS campaign_channel_name,
            'isc ' || s_name AS campaign_internal_source_code,
            CASE WHEN s_acctbal < 0 THEN 'opted out' ELSE 'opted in' END
                AS campaign_optin_preference_desc,
            s_acctbal < 1000 AS campaign_control_flag, s_acctbal < 2000 AS campaign_test_flag,
            s_acctbal < 3000 AS campaign_three_day_suppression_flag,
            CASE WHEN s_acctbal < 2000 THEN 'split' END AS campaign_test_type_desc,
            s_acctbal > 5000 AS campaign_international_flag, p_name AS campaign_product_desc,
            p_type AS campaign_product_content_desc,
            p_retailprice > 1000 AS campaign_revenue_generating_flag,
            'objective ' || r_name AS campaign_objective_desc,
            'subobjective ' || r_name AS campaign_subobjective_desc,
            'category ' || r_name AS campaign_category_name,
            'subcategory ' || r_name AS campaign_subcategory_name, r_name AS campaign_name,
            lower(r_name) AS campaign_friendly_name,
            'class ' || r_name AS campaign_classification_desc,
            'group ' || r_name AS campaign_group_desc, n_name AS segment_name,
            'message ' || n_name AS campaign_message_classification,
            'trigger ' || n_name AS campaign_trigger_type_desc,
            {NULL_FLAG} AS campaign_gho_filter_applied_flag, {BUILD} AS etl_build_mst_ts,
            {_day(BUILD)} AS etl_build_mst_date
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
            JOIN part ON l_partkey = p_partkey
            JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey""",
    "dim_template_latest": f"""
        SELECT p_name AS email_id, p_brand AS email_name, p_type AS service_ticket_number,
            TIMESTAMP '2024-01-01' + to_seconds(p_partkey) - INTERVAL 7 HOUR AS create_mst_ts,
            {BUILD} AS etl_build_mst_ts, {_day(BUILD)} AS etl_build_mst_date
        FROM part
        QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1""",
    "dim_holdout": f"""
        SELECT DISTINCT customer_id, {_mst('o_orderdate')} AS campaign_selection_mst_ts,
            channel_id, id AS shopper_id, market_id, o_orderpriority AS isc_source_code,
            {BUILD} AS etl_build_mst_ts, {_day(_mst('o_orderdate'))} AS snap_date
        FROM (
            SELECT *, CAST(o_custkey AS VARCHAR) AS customer_id,
                CAST(o_orderkey % 10 AS INTEGER) AS channel_id,
                {_locale('o_orderkey')} AS market_id,
                CASE o_orderstatus WHEN 'P' THEN '{'-'.join(OLDER_SNAPSHOT)}'
                    ELSE '{'-'.join(SNAPSHOT)}' END AS snapshot
            FROM orders) LEFT JOIN build ON customer_id = customerid
        WHERE snapshot = '{'-'.join(SNAPSHOT)}'""",
    "insert_overwrite_partitions": """
        SELECT CAST(o_orderkey AS VARCHAR) AS email_send_id, o_orderdate AS email_send_mst_ts,
            CASE WHEN year(o_orderdate) <= 1997 THEN 'second' ELSE 'first' END AS template_name,
            CAST(year(o_orderdate) AS VARCHAR) AS email_send_mst_date,
            o_orderstatus AS email_source_system_name
        FROM orders""",
}


# What a sink query reads back is what it was given.
for _name in (
    "clean_sends", "clean_opens", "queue_stage", "send_fact_ocp", "send_fact_sfmc",
    "response_fact_sfmc", "dim_campaign", "dim_template_latest", "dim_holdout",
):
    STATEMENTS[f"{_name}_sink"] = STATEMENTS[_name]
for _name, _same in {
    "first_response_flags_kept": "first_response_flags",
    "stage_dedupe_aggregate": "stage_dedupe_keyed",
    "bucketed_open_send": "norm_join_open_send",
    "latest_build_null": "latest_build",
}.items():
    STATEMENTS[_name] = STATEMENTS[_same]
_ORDER_TEXTS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
        CASE WHEN o_orderkey % 7 = 0 THEN o_custkey || ' USD' WHEN o_orderkey % 5 <> 0
            THEN CAST(o_custkey AS VARCHAR) END AS customer,
        CASE WHEN o_orderkey % 11 = 0 THEN 'no day'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders"""
STATEMENTS["tolerant_casts"] = f"""
    SELECT CAST(order_id AS INTEGER) AS order_id, TRY_CAST(customer AS BIGINT) AS customer,
        CAST(TRY_CAST(day AS DATE) AS VARCHAR) AS day,
        nullif(concat_ws('; ',
            CASE WHEN customer IS NOT NULL AND TRY_CAST(customer AS BIGINT) IS NULL
                THEN 'customer is no bigint: ' || customer END,
            CASE WHEN TRY_CAST(day AS DATE) IS NULL THEN 'day is no date: ' || day END), '')
            AS reject_reason
    FROM ({_ORDER_TEXTS})"""
STATEMENTS["attribution_counts"] = f"""
    SELECT 'opens' AS point, count(*) AS rows FROM ({STATEMENTS['clean_opens']})
    UNION ALL
    SELECT 'opens with sends', count(*) FROM ({STATEMENTS['norm_join_open_send']})
    UNION ALL
    SELECT 'opens with queue rows', count(*) FROM ({STATEMENTS['open_queue_fanout']})"""
STATEMENTS["click_lookup"] = f"""
    SELECT u.emailqueueid, c.createdate AS email_response_mst_ts, c.content_block_id,
        c.visit AS content_block_click_visit_guid, c.visitor AS content_block_click_visitor_guid,
        c.eid AS content_block_click_eid_text, t.content_block_key_id
    FROM src_clicks c JOIN src_tracking t ON c.trackingcode = t.trackingcode
        JOIN src_queue_success u ON t.emailqueuesuccessid = u.emailqueuesuccessid
    WHERE starts_with(c.eid, 'ocp.email.')
        AND c.createdate BETWEEN TIMESTAMP '{LOOKUP_FROM}' AND TIMESTAMP '{LOOKUP_TO}'"""
STATEMENTS["csv_rejects"] = f"""
    SELECT CAST(order_id AS INTEGER) AS order_id,
        concat_ws(',', order_id, coalesce(customer, ''), day) AS reject_record,
        'malformed line' AS reject_reason
    FROM ({_ORDER_TEXTS})
    WHERE TRY_CAST(day AS DATE) IS NULL
        OR customer IS NOT NULL AND TRY_CAST(customer AS BIGINT) IS NULL"""
STATEMENTS["response_fact_ocp_sink"] = STATEMENTS["flagged_response_fact_ocp"]
STATEMENTS["versioned_partitions"] = f"""
    SELECT *, 'newest' AS state FROM ({STATEMENTS['insert_overwrite_partitions']})
    WHERE email_send_mst_date <> '1992'
    UNION ALL BY NAME
    SELECT * REPLACE ('first' AS template_name), 'run 1' AS state
    FROM ({STATEMENTS['insert_overwrite_partitions']})"""

WHOLE_EVENTS = (EVENTS_FIRST_DAY, RESPONSES_END_DAY, EVENTS_END_DAY)
# Runs whose ranges cut.
RANGES = {
    "response_fact_ocp_window": (WINDOW, WHOLE_EVENTS),
    "conform_events_window": (WHOLE, (WINDOW_FIRST_TS, WINDOW_END_TS, WINDOW_RUN_END_TS)),
}


def _with(name: str, statement: str) -> str:
    """Prefix the shared definitions a statement mentions, directly or through others."""
    definitions = _definitions(*RANGES.get(name, (WHOLE, WHOLE_EVENTS)))
    needed: list[str] = []
    text = statement
    for other in reversed(definitions):
        if re.search(rf"\b(FROM|JOIN)\s+{other}\b", text):
            needed.append(other)
            text += "\n" + definitions[other]
    if not needed:
        return statement.strip()
    prefix = ",\n".join(f"{other} AS ({definitions[other]})" for other in reversed(needed))
    return f"WITH {prefix}\n{statement.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: _with(name, statement) for name, statement in STATEMENTS.items()}
