"""How the plans behave with hot keys and long histories, and what reaches the scans."""

import re

import pytest
from helpers import count, planned, ran
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mailfacts import catalogue, plans
from mailfacts.functions import Bounds, from_year_month
from mailfacts.operators.attribution import (
    click_attribution,
    open_sends,
    tracked_clicks,
    with_email_keys,
)
from mailfacts.operators.customers import add_customer
from mailfacts.operators.dedupe import keep_matching, latest_per_key
from mailfacts.operators.events import in_mst_range
from mailfacts.operators.first_response import first_response_flags
from mailfacts.operators.sfmc import join_responses
from mailfacts.plans.sends import queued_sends
from mailfacts.session import INITIAL_PARTITIONS, PARTITION_BYTES, input_bytes, size_shuffles
from mailfacts.sources.scans import SFMC_KEYS

N = 240_000
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def like_a_cluster(settings):
    """Nothing is small enough to broadcast, and a hot partition is one of a few hundred KB."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="60KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="30KB",
    )


def splits_hot_keys(plan):
    return re.search(r"(SortMerge|ShuffledHash)Join\(skew=true\)", plan) is not None


def hot(number, others=20_000):
    """A key that a third of all rows share."""
    return F.when(number % 3 == 0, F.lit(0)).otherwise(number % others)


@pytest.mark.parametrize("hash_limit", ["0", "64MB"])
def test_first_response_splits_a_hot_email(spark, like_a_cluster, settings, hash_limit):
    settings(spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=hash_limit)
    number = F.col("id")
    unset = F.lit(None).cast("boolean")
    df = spark.range(0, N, 1, 16).select(
        hot(number).cast("string").alias("email_send_id"),
        F.lit("open").alias("email_response_type"),
        F.lit("o").alias("email_response_code"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=number)).alias(
            "email_response_mst_ts"
        ),
        F.lit("2024-01-05").alias("email_response_mst_date"),
        F.lit("ocp").alias("email_source_system_name"),
        *(unset.alias(f"first_{kind}_flag") for kind in ("open", "click", "complaint")),
    )
    flagged = first_response_flags(df, "2024-01-01", "2024-01-01", "2024-02-01")
    result, plan = ran(flagged.groupBy("first_open_flag").count())
    emails = df.select("email_send_id").distinct().count()
    assert {row[0]: row[1] for row in result} == {True: emails, False: N - emails}
    assert splits_hot_keys(plan)


def sends_and_opens(spark):
    number = F.col("id")
    keys = [
        hot(number).cast("string").alias("shopper_id"),
        hot(number).cast("string").alias("message_id"),
        F.lit("isc").alias("isc_code"),
        F.lit(1).alias("template_id"),
    ]
    opens = with_email_keys(spark.range(0, N, 1, 16).select(*keys, number.alias("open_id")))
    sends = spark.range(0, N // 2, 1, 16).select(
        *keys,
        number.alias("email_id"),
        number.alias("customermap_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("sent_mst_ts"),
        number.alias("emailsourcekey"),
        F.lit(7).alias("emailsource_id"),
        F.lit("d").alias("shopper_email_domain_name"),
    )
    return opens, with_email_keys(sends)


def test_open_attribution_splits_a_hot_email(spark, like_a_cluster):
    opens, sends = sends_and_opens(spark)
    joined = open_sends(opens, sends)
    result, plan = ran(
        joined.agg(F.count("*"), F.count("email_id"), F.countDistinct("email_id"))
    )
    emails = opens.select("message_id").distinct().count()
    assert tuple(result[0]) == (N, N, emails)
    assert splits_hot_keys(plan)


def test_sfmc_responses_split_a_hot_email(spark, like_a_cluster):
    number = F.col("id")
    keys = [hot(number).alias(SFMC_KEYS[0]), *((hot(number) % 2).alias(k) for k in SFMC_KEYS[1:])]
    payload = F.sha2(number.cast("string"), 256).alias("payload")
    events = spark.range(0, N, 1, 16).select(*keys, payload)
    sent = spark.range(1, 20_001, 1, 4).select(*keys).groupBy(*SFMC_KEYS).count()
    log = sent.select(*SFMC_KEYS, F.col("count").alias("entry"))
    answered = events.join(sent, SFMC_KEYS, "left_semi").count()
    assert answered > N / 2
    joined = join_responses(events, sent, log)
    result, plan = ran(joined.agg(F.count("*"), F.count("entry"), F.max("payload")))
    assert tuple(result[0])[:2] == (N, answered)
    assert splits_hot_keys(plan)


def test_unknown_customers_are_split(spark, like_a_cluster):
    number = F.col("id")
    facts = spark.range(0, N, 1, 16).select(
        F.when(number % 3 > 0, (number % 20_000).cast("string")).alias("customer_id"),
        F.sha2(number.cast("string"), 256).alias("payload"),
    )
    some = spark.range(20_000).select(F.col("id").cast("string").alias("c"))
    result, plan = ran(
        add_customer(
            facts,
            some.select(F.col("c").alias("QaCustomerID")),
            some.select(F.col("c").alias("customer_id"), F.col("c").alias("shopper_id")),
            some.select(F.col("c").alias("shopper_id"), F.lit("US").alias("shopper_country_code")),
            wanted=facts,
        ).agg(
            F.count("*"),
            F.count("exclude_reason_desc"),
            F.count("shopper_country_code"),
            F.max("payload"),
        )
    )
    assert result[0][0] == N and result[0][1] == result[0][2] == N * 2 // 3
    assert splits_hot_keys(plan)


def test_clean_layer_splits_a_hot_customer(spark, like_a_cluster):
    number = F.col("id")
    opens = spark.range(0, N, 1, 16).select(
        number.alias("email_open_id"),
        number.cast("string").alias("message_id"),
        F.lit("i").alias("isccode"),
        F.lit(1).alias("template_id"),
        F.lit("2024-01-05").cast("timestamp_ntz").alias("opendate"),
        F.lit("fr").alias("lang"),
        F.lit(1).alias("privatelabel_id"),
        hot(number).alias("customermap_id"),
    )
    customers = spark.range(0, 20_000, 1, 4).select(
        F.col("id").alias("customermap_id"),
        F.col("id").cast("string").alias("shopperid"),
        F.lit("d").alias("emaildomain"),
    )
    clean = plans.clean_opens(opens, customers, "2024-01-01", "2024-02-01", "2024-03-01")
    result, plan = ran(clean.agg(F.count("*"), F.countDistinct("email_open_id")))
    assert tuple(result[0]) == (N, N)
    assert splits_hot_keys(plan)


def test_dedupe_sends_one_row_per_key_and_task_to_the_shuffle(spark):
    df = spark.range(0, N, 1, 16).select(hot(F.col("id"), 10).alias("k"), F.col("id").alias("t"))
    plan = planned(latest_per_key(df, ["k"], ["t"]))
    partial, exchange, final = (
        plan.index(text) for text in ("1, Partial", "Exchange hashpartitioning", "1, Final")
    )
    assert final < exchange < partial  # printed from the last step to the first


def test_history_is_cut_before_it_is_joined(spark, like_a_cluster):
    """The cut and the dedupe of sends share one shuffle, the join adds one per side."""
    opens, sends = sends_and_opens(spark)
    plan = planned(open_sends(opens, sends))
    assert count(r"LeftSemi", plan) == 1 and count(r"LeftOuter", plan) == 1
    # opened keys: distinct and semi join; sends: semi join; then one for each join side.
    assert count(r"Exchange hashpartitioning", plan) == 5


def test_small_keys_are_broadcast_by_measured_size(spark):
    df = spark.range(0, N, 1, 4).withColumn("k", F.col("id") % 1000)
    few = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in ran(keep_matching(df, few, ["k"]))[1]


def writes_while_built(name):
    return name.endswith("_sink") or name in ("insert_overwrite_partitions", "exclusion_flag")


def test_plans_start_no_job_and_force_no_broadcast_or_cross_join(spark, like_a_cluster):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "nothing may run")
    for name, query in catalogue.queries().items():
        if writes_while_built(name):
            continue
        plan = planned(query(spark, FOLDER))
        assert "Broadcast" not in plan, name
        assert "Cartesian" not in plan, name
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup(None, None)


def click_sources(spark, tmp_path):
    """A million links and stage rows, ten clicks; stored, as Spark filters scans at run time."""
    number, day = F.col("id"), F.lit("2024-01-05").cast("timestamp_ntz")
    frames = {
        "clicks": spark.range(10).select(
            (number * 7).cast("string").alias("trackingcode"),
            number.cast("string").alias("content_block_id"),
            day.alias("email_response_mst_ts"),
            F.lit("v").alias("content_block_click_visit_guid"),
            F.lit("w").alias("content_block_click_visitor_guid"),
            F.lit("ocp.email.1").alias("content_block_click_eid_text"),
        ),
        "tracking": spark.range(N).select(
            number.cast("string").alias("trackingcode"),
            number.alias("emailqueuesuccessid"),
            F.lit("b").alias("content_block_key_id"),
        ),
        "success": spark.range(N).select(
            number.alias("emailqueuesuccessid"), number.alias("emailqueueid")
        ),
        "stage": spark.range(2 * N).select(
            number.alias("emailqueueid"),
            (number % N).cast("string").alias("messageguid"),
            F.lit(1).alias("templateid"),
            F.lit(5).cast("long").alias("redpointcontactid"),
            F.lit("s").alias("email_queue_shopper_id"),
            F.when(number < N, "2024-01-01").otherwise("2024-01-02").alias("email_queue_create_date"),
        ),
        "sends": spark.range(N).select(
            F.lit("S").alias("shopper_id"),
            number.cast("string").alias("message_id"),
            F.lit("isc").alias("isc_code"),
            F.lit(1).alias("template_id"),
            F.lit("en").alias("language_code"),
            F.lit(1).alias("privatelabel_id"),
            number.alias("customermap_id"),
            number.alias("email_id"),
            day.alias("sent_mst_ts"),
            number.alias("emailsourcekey"),
            F.lit(7).alias("emailsource_id"),
            F.lit("d").alias("shopper_email_domain_name"),
        ),
    }
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in frames}


def test_stage_and_sends_are_cut_to_the_clicks(spark, like_a_cluster, tmp_path):
    """Semi joins stand below both dedupes, and a later stage row of a clicked message wins."""
    t = click_sources(spark, tmp_path)
    clicks = tracked_clicks(t["clicks"], t["tracking"], t["success"])
    result = click_attribution(clicks, t["stage"], t["sends"])
    assert result.count() == 0  # each clicked queue row is hidden by a later one
    first = t["stage"].where(F.col("email_queue_create_date") == "2024-01-01")
    found, plan = ran(click_attribution(clicks, first, t["sends"]))
    assert sorted(row.email_id for row in found) == [7 * i for i in range(10)]
    for window in plan.split("Window [")[1:]:
        assert "LeftSemi" in window
    assert count(r"LeftSemi", plan) >= 3


def test_tracking_is_filtered_by_the_keys_of_the_clicks(spark, like_a_cluster, settings, tmp_path):
    settings(
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1KB",
    )
    t = click_sources(spark, tmp_path)
    clicks = tracked_clicks(t["clicks"], t["tracking"], t["success"])
    assert "might_contain" in planned(clicks)
    assert clicks.count() == 10


def test_customers_and_shoppers_are_cut_to_the_facts(spark, like_a_cluster):
    """Neither dimension is made distinct or joined before it is cut."""
    for name in ("send_fact_sfmc", "response_fact_sfmc"):
        plan = planned(entry.queries()[name](spark, FOLDER))
        joins = [line for line in plan.splitlines() if "Join [" in line]
        assert any("LeftSemi" in line and "[customer_id" in line for line in joins), name
        assert any("LeftSemi" in line and "[shopper_id" in line for line in joins), name


def test_queued_contacts_are_distinct_before_the_join(spark, like_a_cluster):
    """Hundreds of sends and queue rows of one message give one row for each send and contact, and
    a message that a third of all sends share is split."""
    number = F.col("id")
    day = F.lit("2024-01-05").cast("timestamp_ntz")
    message = hot(number).cast("string")
    sends = spark.range(0, N, 1, 16).select(
        message.alias("message_id"),
        F.lit(1).alias("template_id"),
        F.lit("2024-01-05").alias("sent_mst_date"),
        number.alias("email_id"),
        F.sha2(number.cast("string"), 256).alias("payload"),
    )
    detail = spark.range(0, N // 4, 1, 8).select(
        number.alias("emailqueueid"),
        message.alias("messageguid"),
        (number % 2).alias("redpointcontactid"),
        F.lit(0).alias("isautomatedseedlist"),
        F.lit(0).alias("istestsend"),
        day.alias("emailqueuecreatedate"),
        F.lit(1).alias("privatelabelid"),
        F.lit("s").alias("shopperid"),
        F.lit("c").alias("sourcecode"),
    )
    success = detail.select("emailqueueid", F.lit(1).alias("templateid"), "emailqueuecreatedate")
    joined = queued_sends(sends, detail, success, "2024-01-01", "2024-01-01", "2024-02-01")
    result, plan = ran(joined.agg(F.count("*"), F.countDistinct("email_id", "redpointcontactid"), F.max("payload")))
    assert result[0][0] == result[0][1]
    assert splits_hot_keys(plan)


def test_shuffles_start_with_partitions_for_all_inputs(spark, settings, tmp_path):
    settings(**{INITIAL_PARTITIONS.replace(".", "__"): "1"}, spark__sql__shuffle__partitions="8")
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    df = spark.read.parquet(path)
    size = input_bytes(df)
    assert 0 < size < 100_000 and input_bytes(df.union(df)) == 2 * size
    size_shuffles(df.groupBy("id").count())
    assert spark.conf.get(INITIAL_PARTITIONS) == "8"
    large = spark.range(50 * PARTITION_BYTES // 8)
    size_shuffles(large.union(large))
    assert spark.conf.get(INITIAL_PARTITIONS) == "100"


def test_flags_read_each_scan_narrow(spark, like_a_cluster):
    """History is read with the three columns it needs, not the wide rows."""
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.col("l_orderkey").alias("email_send_id"),
        F.col("l_returnflag").alias("email_response_type"),
        F.col("l_returnflag").alias("email_response_code"),
        F.col("l_shipdate").alias("email_response_mst_ts"),
        F.col("l_linestatus").alias("email_response_mst_date"),
        F.col("l_linestatus").alias("email_source_system_name"),
        "l_tax",
        "l_discount",
        *(F.lit(None).cast("boolean").alias(f"first_{kind}_flag") for kind in
          ("open", "click", "complaint")),
    )
    plan = first_response_flags(df, "B", "A", "Z")._jdf.queryExecution().toString()
    reads = [line for line in plan.splitlines() if "ReadSchema" in line and "FileScan" in line]
    assert sorted("l_tax" in line for line in reads[-3:]) == [False, False, True]


def test_mst_bounds_reach_the_scan(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet").select(
        F.col("ts").alias("event_utc_ts"), F.lit(2024).alias("year"), F.lit(1).alias("month")
    )
    bounds = Bounds("2024-01-08", "2024-01-22")
    plan = planned(in_mst_range(df, bounds, from_year_month(bounds.lo)))
    assert "GreaterThanOrEqual(ts,2024-01-08T07:00)" in plan
    assert "LessThanOrEqual(ts,2024-01-22T07:00)" in plan


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "events")
    (
        spark.createDataFrame(
            [("2023-12-31 08:00:00", "2023", "12"), ("2024-01-01 02:00:00", "2024", "01"),
             ("2023-11-01 02:00:00", "2023", "11")],
            "event_utc_ts string, year string, month string",
        )
        .withColumn("event_utc_ts", F.col("event_utc_ts").cast("timestamp_ntz"))
        .write.partitionBy("year", "month")
        .parquet(path)
    )
    df = spark.read.schema("event_utc_ts timestamp_ntz, year string, month string").parquet(path)
    bounds = Bounds("2023-12-31", "2024-01-01")
    cut = in_mst_range(df, bounds, from_year_month(bounds.lo))
    assert cut.count() == 2
    plan = planned(cut)
    assert "PartitionFilters: []" not in plan and "year" in plan.split("PartitionFilters")[1]


def test_latest_build_prunes_partitions(spark, tmp_path):
    from mailfacts.operators.builds import latest_build

    path = str(tmp_path / "builds")
    spark.range(10).selectExpr("id", "concat('b', id % 2) AS build_ts").write.partitionBy(
        "build_ts"
    ).parquet(path)
    df = latest_build(spark.read.parquet(path))
    # The newest build is a literal: no file is read to find it.
    assert "Subquery" not in planned(df) and count("FileScan", planned(df)) == 1
    assert sorted(row.id for row in df.collect()) == [1, 3, 5, 7, 9]
    assert "build_ts" in planned(df).split("PartitionFilters")[1]


def test_content_joins_clicks_only(spark, like_a_cluster):
    plan = planned(entry.queries()["response_fact_ocp"](spark, FOLDER))
    union = plan.index("Union")
    assert "[content_block_key_id" not in plan[:union]
