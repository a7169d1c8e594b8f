"""Operators on hand-made rows."""

import random

import pytest
from helpers import at, frame, rows

from mailfacts.operators.attribution import (
    click_attribution,
    open_attribution,
    tracked_clicks,
)
from mailfacts.operators.builds import latest_build
from mailfacts.operators.channels import channel_split, channel_split_union
from mailfacts.operators.conform import conform
from mailfacts.operators.content import add_content, content_hierarchy
from mailfacts.operators.customers import flag_excluded
from mailfacts.operators.dedupe import keep_matching, latest_per_key
from mailfacts.operators.first_response import first_response_flags, first_response_flags_join
from mailfacts.operators.sfmc import join_responses
from mailfacts.sources import schemas
from mailfacts.sources.scans import exclusion_csv

RESPONSE = (
    "email_send_id string, email_response_type string, email_response_code string,"
    " email_response_mst_ts timestamp_ntz, email_response_mst_date string,"
    " email_source_system_name string, first_open_flag boolean, first_click_flag boolean,"
    " first_complaint_flag boolean, n int"
)


def responses(spark, *data):
    """(id, type, code, time, system); the date is cut from the time, or 2024-01-05."""
    full = []
    for n, (email, kind, code, time, system) in enumerate(data):
        day = (time or "2024-01-05")[:10]
        full.append((email, kind, code, at(time), day, system, None, None, None, n))
    return frame(spark, RESPONSE, *full)


@pytest.fixture(params=[first_response_flags, first_response_flags_join])
def flags(request):
    def run(df, start, all_start, end):
        names = ("first_open_flag", "first_click_flag", "first_complaint_flag")
        result = request.param(df, start, all_start, end).orderBy("n").collect()
        return {row["n"]: "".join("FT"[row[name]] for name in names) for row in result}

    return run


def test_first_response_rules(spark, flags):
    df = responses(
        spark,
        ("s1", "open", "o", "2024-01-01", "ocp"),
        ("s1", "open", "o", "2024-01-02", "ocp"),
        ("s1", "open", "o", None, "ocp"),
        ("s1", None, "o", "2024-01-01", "ocp"),
        ("s1", None, "o", "2024-01-03", "ocp"),
        ("s2", "open", "o", "2024-01-05", "ocp"),
        ("s2", "open", "o", "2024-01-05", "ocp"),
        ("s2", "click", "c", "2024-01-06", "ocp"),
        (None, "open", "o", "2024-01-01", "ocp"),
        (None, "open", "o", "2024-01-09", "ocp"),
        ("s3", "spam", "s", "2024-01-09", "ocp"),
        ("s3", "open", None, "2024-01-09", "ocp"),
    )
    assert flags(df, "2024-01-01", "2024-01-01", "2024-02-01") == {
        0: "TFF",
        1: "FFF",
        2: "TFF",
        3: "TFF",
        4: "TFF",
        5: "TFF",
        6: "TFF",
        7: "FTF",
        8: "TFF",
        9: "TFF",
        10: "FFT",
        11: "FFF",
    }


def test_history_before_the_rewritten_range_counts(spark, flags):
    df = responses(
        spark,
        ("s", "open", "o", "2024-01-02", "ocp"),
        ("s", "open", "o", "2024-01-12", "ocp"),
        ("t", "open", "o", "2024-01-12", "ocp"),
        ("u", "open", "o", "2023-12-31", "ocp"),
        ("u", "open", "o", "2024-01-12", "ocp"),
        ("u", "open", "o", "2024-02-12", "ocp"),
    )
    # u: the row before all_start does not count, the row after the end is left alone.
    assert flags(df, "2024-01-10", "2024-01-01", "2024-01-31") == {1: "FFF", 2: "TFF", 4: "TFF"}


def test_other_systems_are_left_out(spark, flags):
    df = responses(
        spark,
        ("s", "open", "o", "2024-01-01", "sfmc"),
        ("s", "open", "o", "2024-01-02", None),
        ("s", "open", "o", "2024-01-03", "ocp"),
    )
    assert flags(df, "2024-01-01", "2024-01-01", "2024-02-01") == {2: "TFF"}


def test_flagging_removes_duplicates(spark):
    df = responses(spark, ("s", "open", "o", "2024-01-01", "ocp"))
    twice = df.unionByName(df)
    for build in (first_response_flags, first_response_flags_join):
        assert build(twice, "2024-01-01", "2024-01-01", "2024-02-01").count() == 1


def test_flags_equal_brute_force(spark, flags):
    chance = random.Random(7)
    data = [
        (
            chance.choice(["a", "b", "c", None]),
            chance.choice(["open", "click", None]),
            chance.choice(["o", "c", "s", None]),
            chance.choice([None, *(f"2024-01-{day:02}" for day in range(1, 29))]),
            chance.choice(["ocp", "ocp", "redpoint", "sfmc", None]),
        )
        for _ in range(300)
    ]
    start, all_start, end = "2024-01-08", "2024-01-03", "2024-01-25"
    day = {n: (row[3] or "2024-01-05")[:10] for n, row in enumerate(data)}
    own = {n: row for n, row in enumerate(data) if row[4] not in ("sfmc", None)}
    expected = {}
    for n, (email, kind, code, time, _) in own.items():
        if not start <= day[n] <= end:
            continue
        earlier = email and kind and time and any(
            other[:2] == (email, kind) and other[3] and other[3] < time
            for m, other in own.items()
            if all_start <= day[m] <= end
        )
        expected[n] = "".join("FT"[code == flag and not earlier] for flag in "ocs")
    assert flags(responses(spark, *data), start, all_start, end) == expected


@pytest.mark.parametrize("split", [channel_split, channel_split_union])
def test_channel_split(spark, split):
    data = [(contact, source) for contact in (None, 0, 5) for source in (7, 8, 13, None)]
    df = frame(spark, "redpointcontactid long, emailsource_id int", *data)
    got = rows(
        split(df, "mass mailer"),
        "redpointcontactid",
        "emailsource_id",
        "email_source_system_name",
        "email_holdout_flag",
        "email_control_flag",
        "email_sent_flag",
    )
    expected = {(5, 9999, "redpoint", False, False, True): 4}
    for contact in (None, 0):
        expected |= {
            (contact, 7, "ocp", False, False, True): 1,
            (contact, 8, "mass mailer", False, False, True): 1,
            (contact, 13, "ocp", True, False, False): 1,
            (contact, None, "ocp", False, False, True): 1,
        }
    assert got == expected


def test_control_flag_reads_a_channel_name(spark):
    df = frame(
        spark,
        "redpointcontactid long, emailsource_id int, channel_name string",
        (1, 7, "a control group"),
        (1, 7, "mail"),
        (1, 7, None),
    )
    got = rows(channel_split(df, "m"), "channel_name", "email_control_flag")
    assert got == {("a control group", True): 1, ("mail", False): 1, (None, False): 1}


def test_latest_per_key(spark):
    df = frame(
        spark,
        "k string, name string, t timestamp_ntz",
        ("k", "old", at("2024-01-01")),
        ("k", "new", at("2024-01-02")),
        ("tie", "a", at("2024-01-01")),
        ("tie", "b", at("2024-01-01")),
        ("null", "x", None),
        ("null", "y", at("2024-01-01")),
        (None, "z", None),
        (None, "w", None),
    )
    got = rows(latest_per_key(df, ["k"], ["t"]), "k", "name")
    assert got == {("k", "new"): 1, ("tie", "b"): 1, ("null", "y"): 1, (None, "z"): 1}


def test_latest_per_key_ignores_partitioning(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id % 3 AS t", "id")
    results = [
        rows(latest_per_key(df.repartition(n), ["k"], ["t"])) for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_keep_matching_keeps_multiplicity(spark):
    df = frame(spark, "k int, v int", (1, 1), (1, 1), (2, 1), (None, 1))
    wanted = frame(spark, "k int", (1,), (1,), (1,), (None,))
    assert rows(keep_matching(df, wanted, ["k"])) == {(1, 1): 2}


def test_latest_build(spark):
    df = frame(spark, "id int, build_ts string", (1, "2024-01"), (2, "2024-02"), (3, "2024-02"))
    assert rows(latest_build(df), "id") == {(2,): 1, (3,): 1}
    assert latest_build(df.where("false")).count() == 0


def test_exclusion_flags_once(spark):
    df = frame(spark, "customer_id string", ("1",), ("1",), ("2",), (None,))
    listed = frame(spark, "QaCustomerID string", ("1",), ("1",), ("9",), (None,))
    got = rows(flag_excluded(df, listed), "customer_id", "exclude_reason_desc")
    assert got == {("1", "internal customer"): 2, ("2", None): 1, (None, None): 1}


def test_exclusion_file_is_read_by_header(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("Name,QaCustomerID\nsomeone,007\nother,8\n")
    assert rows(exclusion_csv(spark, str(path))) == {("007",): 1, ("8",): 1}


def test_hierarchy_keeps_unknown_levels(spark):
    keys = frame(
        spark,
        "content_block_key_id string, content_block_key_name string,"
        " content_block_subcategory_id string",
        ("1", "one", "10"),
        ("2", "two", "20"),
        ("3", "three", None),
    )
    subs = frame(
        spark,
        "content_block_subcategory_id string, content_block_subcategory_name string,"
        " content_block_category_id string",
        ("10", "ten", "100"),
        ("20", "twenty", "200"),
    )
    cats = frame(
        spark,
        "content_block_category_id string, content_block_category_name string",
        ("100", "hundred"),
    )
    facts = frame(spark, "content_block_key_id string", ("1",), ("2",), ("3",), ("4",), (None,))
    got = rows(
        add_content(facts, content_hierarchy(keys, subs, cats)),
        "content_block_key_id",
        "content_block_key_name",
        "content_block_subcategory_name",
        "content_block_category_name",
    )
    assert got == {
        ("1", "one", "ten", "hundred"): 1,
        ("2", "two", "twenty", None): 1,
        ("3", "three", None, None): 1,
        ("4", None, None, None): 1,
        (None, None, None, None): 1,
    }


def test_conform_refuses_unplanned_columns(spark):
    df = frame(spark, "email_id string", ("x",))
    with pytest.raises(ValueError, match="not in the schema"):
        conform(df, schemas.TEMPLATE_DIM, absent=["nope"])
    with pytest.raises(ValueError, match="absent but present"):
        conform(df, schemas.TEMPLATE_DIM, absent=["email_id"])
    with pytest.raises(Exception, match="email_name"):
        conform(df, schemas.TEMPLATE_DIM)


# --- Attribution ----------------------------------------------------------------------------

SENDS = (
    "email_id long, sent_mst_ts timestamp_ntz, customermap_id long, shopper_id string,"
    " shopper_email_domain_name string, privatelabel_id int, isc_code string,"
    " emailsource_id int, emailsourcekey long, template_id int, message_id string,"
    " language_code string"
)
OPENS = (
    "shopper_id string, message_id string, isc_code string, template_id int,"
    " language_code string, privatelabel_id int, open_mst_ts timestamp_ntz, open_mst_date string"
)
STAGE = (
    "messageguid string, emailqueueid long, templateid int, redpointcontactid long,"
    " email_queue_shopper_id string, email_queue_create_date string"
)


def send(email, time, shopper, message, isc="A", template=1):
    return (email, at(time), 1, shopper, "d", 1, isc, 7, 1, template, message, "en-US")


def opened(shopper, message, isc="A", template=1):
    return (shopper, message, isc, template, "fr", 2, at("2024-01-05"), "2024-01-05")


def test_open_attribution(spark):
    sends = frame(
        spark,
        SENDS,
        send(1, "2024-01-01", "S", "M1"),
        send(2, "2024-01-02", "s ", "m1"),  # the same email in other spelling, and later
        send(3, "2024-01-01", "S", "M2", isc="B"),
        send(4, "2024-01-01", "S", None),
    )
    opens = frame(
        spark,
        OPENS,
        opened("S", " m1", "a"),
        opened("S", " m1", "a"),
        opened("S", "M2"),
        opened("X", "M1"),
        opened("S", None),
    )
    stage = frame(
        spark,
        STAGE,
        ("M1", 1, 1, 5, "S", "2024-01-01"),
        ("M1", 2, 1, 6, "S", "2024-01-01"),
        ("M1", 3, 1, 6, "S", "2024-01-02"),
        ("M2", 4, 1, None, "S", "2024-01-01"),
    )
    got = rows(
        open_attribution(opens, sends, stage),
        "shopper_id",
        "message_id",
        "isc_code",
        "language_code",
        "email_id",
        "shopper_email_domain_name",
        "redpointcontactid",
        "email_response_code",
    )
    # Each open meets both contacts of M1; the open's own values win; nothing is lost.
    assert got == {
        ("S", " m1", "a", "fr", 2, "d", 5, "o"): 2,
        ("S", " m1", "a", "fr", 2, "d", 6, "o"): 2,
        ("S", "M2", "A", "fr", None, None, None, "o"): 1,
        ("X", "M1", "A", "fr", None, None, 5, "o"): 1,
        ("X", "M1", "A", "fr", None, None, 6, "o"): 1,
        ("S", None, "A", "fr", None, None, None, "o"): 1,
    }


def test_sentinel_shoppers_meet(spark):
    sends = frame(spark, SENDS, send(1, "2024-01-01", "NULL", "M"))
    opens = frame(spark, OPENS, opened("NULL", "M"))
    got = rows(open_attribution(opens, sends, frame(spark, STAGE)), "shopper_id", "email_id")
    assert got == {("NULL", 1): 1}


def test_click_chain(spark):
    clicks = frame(
        spark,
        "trackingcode string, content_block_id string, email_response_mst_ts timestamp_ntz,"
        " content_block_click_visit_guid string, content_block_click_visitor_guid string,"
        " content_block_click_eid_text string",
        ("t1", "k1", at("2024-01-05"), "v", "w", "ocp.email.1"),
        ("t1", "k2", at("2024-01-05"), "v", "w", "other.1"),
        ("t2", "k3", at("2024-01-05"), "v", "w", "ocp.email.2"),
        ("t3", "k4", at("2024-01-05"), "v", "w", "ocp.email.3"),
        ("t1", "k5", at("2024-01-05"), "v", "w", None),
    )
    tracking = frame(
        spark,
        "trackingcode string, emailqueuesuccessid long, content_block_key_id string",
        ("t1", 11, "b1"),
        ("t2", 12, "b2"),
        ("t3", 13, "b3"),
    )
    success = frame(
        spark, "emailqueuesuccessid long, emailqueueid long", (11, 1), (12, 2), (13, 3)
    )
    stage = frame(
        spark,
        STAGE,
        ("M1", 1, 1, 5, " s", "2024-01-01"),
        ("M2", 2, 1, 6, "", "2024-01-01"),  # the raw empty id never meets the sentinel
        ("M3", 3, 1, 7, "S", "2024-01-01"),
        ("M3", 9, 1, 8, "S", "2024-01-02"),  # a later row of the same message hides queue id 3
    )
    sends = frame(
        spark,
        SENDS,
        send(1, "2024-01-01", "S", "m1", isc="A"),
        send(2, "2024-01-01", "S", "m1", isc="B"),  # isc is no key here: two rows
        send(3, "2024-01-01", "NULL", "M2"),
        send(4, "2024-01-01", "S", "M3"),
    )
    got = rows(
        click_attribution(tracked_clicks(clicks, tracking, success), stage, sends),
        "email_id",
        "message_id",
        "content_block_id",
        "content_block_key_id",
        "redpointcontactid",
        "email_response_mst_date",
    )
    assert got == {
        (1, "m1", "k1", "b1", 5, "2024-01-05"): 1,
        (2, "m1", "k1", "b1", 5, "2024-01-05"): 1,
    }


def test_sfmc_join_keeps_every_event_and_fan_out(spark):
    keys = "sfmc_job_id long, sfmc_list_id long, sfmc_batch_id long, sfmc_subscriber_id long"
    events = frame(
        spark,
        f"{keys}, kind string",
        (1, 1, 1, 1, "open"),
        (1, 1, 1, 1, "open"),
        (1, 1, 1, 2, "open"),
        (1, 1, None, 1, "open"),
    )
    sent = frame(spark, f"{keys}, s int", (1, 1, 1, 1, 10), (1, 1, None, 1, 11), (9, 9, 9, 9, 12))
    log = frame(spark, f"{keys}, l int", (1, 1, 1, 1, 20), (1, 1, 1, 1, 21), (1, 1, 1, 2, 22))
    got = rows(join_responses(events, sent, log), "sfmc_subscriber_id", "sfmc_batch_id", "s", "l")
    # The log alone does not attribute: subscriber 2 has no send.
    assert got == {
        (1, 1, 10, 20): 2,
        (1, 1, 10, 21): 2,
        (2, 1, None, None): 1,
        (1, None, None, None): 1,
    }
