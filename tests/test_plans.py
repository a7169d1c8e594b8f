"""The jobs on hand-made rows, where the shared tables have no such case."""

from helpers import at, frame, rows

from mailfacts import plans
from mailfacts.functions import Bounds
from mailfacts.operators.sfmc import log_in_range, sent_in_range
from mailfacts.operators.events import EVENT_KINDS, conform_events
from mailfacts.sources import schemas

BUILD = "2024-03-01 08:00:00"
MAP = "customermap_id long, shopperid string, emaildomain string"
EMAIL = (
    "customermap_id long, email_id long, message_id string, sentdate timestamp_ntz,"
    " emailsourcekey long, template_id int, emailsource_id int, lang string, isccode string,"
    " privatelabel_id int"
)


def test_clean_sends(spark):
    customers = frame(spark, MAP, (1, "", None), (2, "b", "x.example"))
    email = [
        (1, 1, "M", at("2024-01-02"), 1, 1, 7, "fr", "", 1),
        (1, 1, "M", at("2024-01-02"), 1, 1, 7, "fr", "", 1),  # an exact duplicate
        (2, 2, "M", at("2024-01-03"), 1, 1, 13, "fr", "I", 1),
        (2, 3, "M", at("2024-01-03 00:00:01"), 1, 1, 8, "fr", None, 1),  # after the end
        (2, 4, "M", at("2024-01-02"), 1, 1, 9, "fr", None, 1),  # another source
        (3, 5, "M", at("2024-01-02"), 1, 1, 7, "fr", None, 1),  # no such customer
    ]
    df = plans.clean_sends(
        frame(spark, EMAIL, *email), customers, "2024-01-01", "2024-01-03", BUILD
    )
    assert df.schema.fieldNames() == schemas.CLEAN_SENDS.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.CLEAN_SENDS]
    columns = ("email_id", "shopper_id", "shopper_email_domain_name", "isc_code", "sent_mst_date")
    assert rows(df, *columns, "etl_build_mst_ts") == {
        (1, "NULL", "NULL", "NULL", "2024-01-02", at(BUILD)): 1,
        (2, "b", "x.example", "I", "2024-01-03", at(BUILD)): 1,
    }


def test_queue_stage_drops_seeds_tests_and_failures(spark):
    detail = (
        "emailqueueid long, messageguid string, redpointcontactid long, isautomatedseedlist int,"
        " istestsend int, emailqueuecreatedate timestamp_ntz, privatelabelid int,"
        " shopperid string, sourcecode string"
    )
    day = at("2024-01-02")
    queued = frame(
        spark,
        detail,
        (1, "M1", 5, 0, 0, day, 1, "", "c"),
        (2, "M2", 5, 1, 0, day, 1, "s", "c"),
        (3, "M3", 5, 0, 1, day, 1, "s", "c"),
        (4, "M4", 5, 0, 0, day, 1, "s", "c"),
        (5, "M5", 5, None, 0, day, 1, "s", "c"),
    )
    success = frame(
        spark,
        "emailqueueid long, templateid int, emailqueuecreatedate timestamp_ntz",
        *((n, 1, day) for n in (1, 2, 3, 5)),
    )
    df = plans.queue_stage(queued, success, "2024-01-01", "2024-01-03")
    # The raw empty shopper id stays empty here.
    assert rows(df, "messageguid", "email_queue_shopper_id", "email_queue_create_date") == {
        ("M1", "", "2024-01-02"): 1
    }


KEYS = "sfmc_job_id long, sfmc_list_id long, sfmc_batch_id long, sfmc_subscriber_id long"


def event_tables(spark, **given):
    common = f"{KEYS}, event_utc_ts timestamp_ntz, year string, month string"
    extra = {
        "open": "event_type_code string, event_unique_flag boolean",
        "bounce": "bounce_category string",
        "click": "event_type_code string, event_unique_flag boolean, url string,"
        " link_name string, link_content string",
        "spam": "event_type_code string",
        "unsubscribe": "event_type_code string",
    }
    return {
        kind: frame(spark, f"{common}, {extra[kind]}", *given.get(kind, ()))
        for kind in EVENT_KINDS
    }


def event(time, *extra):
    return (1, 1, 1, 1, at(time), time[:4], time[5:7], *extra)


def test_december_window_keeps_january_utc(spark):
    tables = event_tables(
        spark,
        open=[
            event("2024-01-01 02:00:00", "Open", True),  # 31 December in MST
            event("2023-12-31 06:59:59", "Open", True),  # 30 December in MST
        ],
    )
    df = conform_events(tables, Bounds("2023-12-31", "2024-01-01"), "2024-01-02")
    assert rows(df, "email_response_mst_ts", "email_response_type") == {
        (at("2023-12-31 19:00:00"), "open"): 1
    }


def test_bounces_run_to_the_end_of_the_run(spark):
    late = "2024-01-20 12:00:00"
    tables = event_tables(
        spark,
        open=[event(late, "Open", None)],
        bounce=[event(late, "Soft Bounce"), event("2024-02-20 12:00:00", "Soft Bounce")],
        spam=[event(late, "Spam")],
    )
    df = conform_events(tables, Bounds("2024-01-01", "2024-01-10"), "2024-01-31")
    assert rows(df, "email_response_type", "email_response_code") == {("soft bounce", "sb"): 1}


def test_events_stored_in_a_later_month_are_kept(spark):
    row = (1, 1, 1, 1, at("2024-01-31 12:00:00"), "2024", "02", "Open", True)
    df = conform_events(
        event_tables(spark, open=[row]), Bounds("2024-01-01", "2024-02-01"), "2024-02-01"
    )
    assert df.count() == 1


def test_sfmc_facts_keep_equal_responses_but_not_equal_sends(spark):
    opened = event("2024-01-05 12:00:00", "Open", True)
    sent_schema = (
        f"{KEYS}, event_utc_ts timestamp_ntz, email_template_name string,"
        " email_template_id string, year string, month string"
    )
    row = (1, 1, 1, 1, at("2024-01-04 12:00:00"), "mail", "t1", "2024", "01")
    sent = frame(spark, sent_schema, row, row)
    log = frame(
        spark,
        f"{KEYS}, locale_code string, event_utc_ts timestamp_ntz, customer_id string,"
        " internal_source_code string, cms_omni_campaign_id int, cms_omni_segment_id int,"
        " cms_omni_channel_id int, private_label_id int, year string, month string",
        (1, 1, 1, 1, "en-US", at("2024-01-04 12:00:00"), "c1", "isc", 1, 2, 3, 4, "2024", "01"),
    )
    listed = frame(spark, "QaCustomerID string", ("c1",), ("c1",))
    customers = frame(spark, "id string, customerid string", ("s1", "c1"), ("s1", "c1"))
    shoppers = frame(spark, "shopper_id string, country string", ("s1", "us"))
    dims = (listed, customers, shoppers)
    sends = plans.send_fact_sfmc(sent, log, *dims, "2024-01-01", "2024-02-01", BUILD)
    assert rows(
        sends, "shopper_id", "shopper_country_code", "exclude_reason_desc", "email_country_code"
    ) == {("s1", "US", "internal customer", "US"): 1}

    responses = plans.response_fact_sfmc(
        event_tables(spark, open=[opened, opened]),
        sent.distinct(),
        log,
        *dims,
        open_start="2024-01-01",
        open_end="2024-02-01",
        send_start="2024-01-01",
        end="2024-02-01",
        build_ts=BUILD,
    )
    assert responses.schema.fieldNames() == schemas.RESPONSE_FACT.fieldNames()
    assert rows(responses, "email_send_mst_date", "email_response_mst_date", "template_id") == {
        ("2024-01-04", "2024-01-05", "t1"): 2
    }


def test_holdout_reads_one_snapshot_and_one_row_per_customer(spark):
    holdout = frame(
        spark,
        "customer_id string, etl_build_utc_ts timestamp_ntz, cms_omni_channel_id int,"
        " locale_code string, internal_source_code string, year string, month string,"
        " day string",
        ("1", at("2024-01-02 03:00:00"), 1, "fr", "i", "2024", "01", "02"),
        ("1", at("2024-01-02 03:00:00"), 1, "fr", "i", "2024", "01", "02"),
        ("2", at("2024-01-02 03:00:00"), 1, "fr", "i", "2024", "01", "02"),
        ("3", at("2024-01-02 03:00:00"), 1, "fr", "i", "2024", "02", "02"),
    )
    customers = frame(spark, "id string, customerid string", ("s1", "1"))
    df = plans.dim_holdout(holdout, customers, "2024", "01", "02", BUILD)
    assert rows(df, "customer_id", "shopper_id", "snap_date") == {
        ("1", "s1", "2024-01-01"): 1,
        ("2", None, "2024-01-01"): 1,
    }


def test_events_stored_under_their_mst_month_are_kept(spark):
    """19:00 on 31 January in MST is 1 February in UTC; either month may be the stored one."""
    stored = [(1, 1, 1, 1, at("2024-02-01 02:00:00"), "2024", m, "Open", True) for m in ("01", "02")]
    window = Bounds("2024-01-31 18:00:00", "2024-02-10")
    df = conform_events(event_tables(spark, open=stored), window, "2024-02-10")
    assert rows(df, "email_response_mst_ts") == {(at("2024-01-31 19:00:00"),): 2}


def test_sends_and_log_are_kept_under_any_month_of_their_year(spark):
    schema = f"{KEYS}, event_utc_ts timestamp_ntz, year string, month string"
    months = ("01", "02", "03")
    sent = frame(spark, schema, *((i, 1, 1, 1, at("2024-02-05"), "2024", m) for i, m in enumerate(months)))
    bounds = Bounds("2024-02-01", "2024-02-10")
    assert sent_in_range(sent, bounds).count() == log_in_range(sent, bounds).count() == 3
    assert sent_in_range(sent, Bounds("2024-02-06", "2024-02-10")).count() == 0
