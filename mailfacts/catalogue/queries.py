"""The query catalogue: one entry per operator or plan."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mailfacts import plans
from mailfacts.catalogue.parameters import (
    BUCKETS,
    BUILD_TS,
    DAY_BEFORE_REFLAG,
    END_DAY,
    EVENTS_END_DAY,
    EVENTS_FIRST_DAY,
    FIRST_DAY,
    FLAG_FROM,
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
    STORED_MONTH,
    WHOLE,
    WINDOW,
    WINDOW_END_TS,
    WINDOW_FIRST_TS,
    WINDOW_RUN_END_TS,
)
from mailfacts.functions import (
    Bounds,
    bounce_code,
    email_key,
    from_year_month,
    locale_country,
    locale_language,
    mst_date,
    to_mst,
)
from mailfacts.functions.labels import MASS_MAILER_IN_SENDS
from mailfacts.operators.attribution import (
    SEND_KEYS,
    click_attribution,
    latest_sends,
    open_attribution,
    open_queue,
    open_sends,
    open_sends_bucketed,
    tracked_clicks,
    with_email_keys,
)
from mailfacts.operators.builds import latest_build
from mailfacts.operators.channels import channel_split, channel_split_union
from mailfacts.operators.content import add_content, content_hierarchy
from mailfacts.operators.counts import Counts
from mailfacts.operators.customers import flag_excluded
from mailfacts.operators.dedupe import latest_per_key, latest_per_key_aggregate
from mailfacts.operators.events import conform_events
from mailfacts.operators.first_response import (
    DATE,
    FLAG_CODES,
    first_response_flags,
    first_response_flags_join,
    own_responses,
)
from mailfacts.operators.kept_minima import flag_with_minima, minima_of
from mailfacts.operators.lookups import tracked_clicks_looked_up, write_for_lookups
from mailfacts.operators.rejects import cast_with_rejects, csv_with_rejects, rejected_rows
from mailfacts.operators.sfmc import join_send_log, log_in_range, sent_in_range
from mailfacts.plans.responses import ATTRIBUTED, ResponseDates, ocp_responses
from mailfacts.session import configure, scratch_dir, size_shuffles
from mailfacts.sources import scans, schemas
from mailfacts.catalogue.fixtures import SNAPSHOT, Fixtures
from mailfacts.sources.buckets import write_bucketed
from mailfacts.sources.schemas import SEND_FACT
from mailfacts.sources.sink import read_table, replace_partitions, write_partitioned
from mailfacts.sources.steps import Keep, Steps, as_planned
from mailfacts.sources.versions import add_run, read_newest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

OCP_DATES = ResponseDates(**WHOLE)
WINDOW_DATES = ResponseDates(**WINDOW)


def _query(name: str) -> Callable[[Callable[[Fixtures], DataFrame]], Query]:
    def register(build: Callable[[Fixtures], DataFrame]) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return size_shuffles(build(Fixtures(configure(spark), sf_dir)))

        _QUERIES[name] = run
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _scratch(fx: Fixtures, name: str) -> str:
    """A new folder below the shared one."""
    return f"{scratch_dir(fx.spark)}/{name}-{uuid4().hex}"


# --- First-response flags -------------------------------------------------------------------


def _unflagged(df: DataFrame) -> DataFrame:
    return df.withColumns({flag: F.lit(None).cast("boolean") for flag in FLAG_CODES})


def _flagged_events(fx: Fixtures, build: Callable[..., DataFrame], start: str) -> DataFrame:
    return build(_unflagged(fx.responses()), start, EVENTS_FIRST_DAY, EVENTS_END_DAY)


@_query("first_response_flags")
def first_response_flags_all(fx: Fixtures) -> DataFrame:
    return _flagged_events(fx, first_response_flags, EVENTS_FIRST_DAY)


@_query("first_response_flags_incremental")
def first_response_flags_incremental(fx: Fixtures) -> DataFrame:
    """Rewrites the second half of the events from the history of all of them."""
    return _flagged_events(fx, first_response_flags, REFLAG_FROM)


@_query("first_response_flags_join")
def first_response_flags_marker_join(fx: Fixtures) -> DataFrame:
    return _flagged_events(fx, first_response_flags_join, REFLAG_FROM)


@_query("first_response_flags_kept")
def first_response_flags_by_kept_minima(fx: Fixtures) -> DataFrame:
    """Two flag runs over a stored fact, the later days first, then the earlier ones as late arrivals. Each
    reads its own days and the kept minima; the second lowers minima of the first."""
    responses = _unflagged(fx.responses())
    partitions = [DATE, "email_source_system_name"]
    path, kept_path = (_scratch(fx, f"first_response_{name}") for name in ("fact", "kept"))
    target = path, responses.schema, partitions
    late_days = F.col(DATE) >= REFLAG_FROM
    kept = minima_of(responses.limit(0))
    for days, start, end in (
        (late_days, REFLAG_FROM, EVENTS_END_DAY),
        (~late_days, EVENTS_FIRST_DAY, DAY_BEFORE_REFLAG),
    ):
        add_run(responses.where(days), *target)
        run = flag_with_minima(read_newest(fx.spark, *target), kept, start, end)
        add_run(run.rows, *target)
        run.minima.write.mode("append").parquet(kept_path)
        kept = fx.spark.read.schema(kept.schema).parquet(kept_path)
    return own_responses(read_newest(fx.spark, *target))


@_query("first_response_ties")
def first_response_ties(fx: Fixtures) -> DataFrame:
    """Line items as responses: many share the earliest day of their order and flag."""
    flag = F.col("l_returnflag")
    lines = fx.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("email_send_id"),
        flag.alias("email_response_type"),
        F.when(flag == "A", "o").when(flag == "R", "c").otherwise("s").alias(
            "email_response_code"
        ),
        F.col("l_shipdate").alias("email_response_mst_ts"),
        F.col("l_shipdate").cast("date").cast("string").alias("email_response_mst_date"),
        F.lit("ocp").alias("email_source_system_name"),
        "l_partkey",
        "l_linenumber",
        "l_suppkey",
    )
    return first_response_flags(_unflagged(lines), FIRST_DAY, FIRST_DAY, END_DAY)


# --- Clean layer and stage ------------------------------------------------------------------


def _clean_sends(fx: Fixtures) -> DataFrame:
    return plans.clean_sends(
        fx.contact_email(), fx.customermap(), FIRST_DAY, END_DAY, BUILD_TS
    )


def _clean_opens(fx: Fixtures) -> DataFrame:
    return plans.clean_opens(
        fx.contact_email_open(), fx.customermap(), FIRST_DAY, END_DAY, BUILD_TS
    )


def _queue_stage(fx: Fixtures) -> DataFrame:
    return plans.queue_stage(fx.queue_detail(), fx.queue_success(), FIRST_DAY, END_DAY)


@_query("clean_sends")
def clean_sends(fx: Fixtures) -> DataFrame:
    return _clean_sends(fx)


@_query("clean_opens")
def clean_opens(fx: Fixtures) -> DataFrame:
    return _clean_opens(fx)


@_query("queue_stage")
def queue_stage(fx: Fixtures) -> DataFrame:
    return _queue_stage(fx)


@_query("stage_distinct")
def stage_distinct(fx: Fixtures) -> DataFrame:
    return _queue_stage(fx).select("messageguid", "templateid", "redpointcontactid").distinct()


@_query("stage_dedupe_keyed")
def stage_dedupe_keyed(fx: Fixtures) -> DataFrame:
    """One line per (order, return flag), the latest shipped."""
    lines = fx.table("lineitem").select(
        "l_orderkey", "l_returnflag", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return latest_per_key(lines, ["l_orderkey", "l_returnflag"], ["l_shipdate", "l_linenumber"])


@_query("send_dedupe_latest")
def send_dedupe_latest(fx: Fixtures) -> DataFrame:
    return latest_sends(with_email_keys(_clean_sends(fx))).select(
        "shopper_id", "message_id", "isc_code", "template_id", "email_id", "sent_mst_ts"
    )


@_query("stage_dedupe_aggregate")
def stage_dedupe_aggregate(fx: Fixtures) -> DataFrame:
    """The same by an aggregate."""
    lines = fx.table("lineitem").select(
        "l_orderkey", "l_returnflag", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return latest_per_key_aggregate(
        lines, ["l_orderkey", "l_returnflag"], ["l_shipdate", "l_linenumber"]
    )


@_query("parameterised_sql")
def parameterised_sql(fx: Fixtures) -> DataFrame:
    """A range bound as SQL parameters rather than as formatted text."""
    return fx.spark.sql(
        "SELECT messageguid, templateid, redpointcontactid FROM {stage}"
        " WHERE email_queue_create_date >= :start AND email_queue_create_date <= :end"
        " GROUP BY 1, 2, 3",
        args={"start": PRUNE_FROM, "end": PRUNE_TO},
        stage=_queue_stage(fx),
    )


# --- Keys, labels and time ------------------------------------------------------------------


@_query("email_key")
def email_keys(fx: Fixtures) -> DataFrame:
    return fx.contact_email().select(
        "email_id",
        "message_id",
        email_key(
            "message_id", "customermap_id", F.lower(F.nullif("isccode", F.lit(""))), "template_id"
        ).alias("email_send_id"),
    )


@_query("locale_parts")
def locale_parts(fx: Fixtures) -> DataFrame:
    return fx.contact_email().select(
        "email_id",
        locale_language("lang").alias("email_language_code"),
        locale_country("lang").alias("email_country_code"),
    )


@_query("bounce_code")
def bounce_codes(fx: Fixtures) -> DataFrame:
    return fx.sfmc_events()["bounce"].select(
        "event_id",
        F.lower("bounce_category").alias("email_response_type"),
        bounce_code(F.lower("bounce_category")).alias("email_response_code"),
    )


@_query("mst_dates")
def mst_dates(fx: Fixtures) -> DataFrame:
    mst = to_mst("ts")
    return fx.table("events").select(
        "event_id", mst.alias("mst_ts"), mst_date(mst).alias("mst_date")
    )


@_query("mst_bound_pushdown")
def mst_bound_pushdown(fx: Fixtures) -> DataFrame:
    """An MST range tested on the stored UTC column."""
    events = fx.table("events")
    bounds = Bounds(SHIFT_FROM, SHIFT_TO).mst_to_utc()
    in_range = events.where(bounds.within(events, "ts"))
    return in_range.select("event_id", to_mst("ts").alias("mst_ts"))


@_query("year_month_prune")
def year_month_prune(fx: Fixtures) -> DataFrame:
    orders = fx.table("orders")
    return orders.where(
        from_year_month(PRUNE_FROM, F.year("o_orderdate"), F.month("o_orderdate"))
    ).select("o_orderkey", "o_orderdate")


@_query("shopper_country")
def shopper_country(fx: Fixtures) -> DataFrame:
    return _clean_sends(fx).join(scans.shoppers(fx.shopper()), "shopper_id", "left").select(
        "email_id", "shopper_id", "shopper_country_code"
    )


# --- OCP world ------------------------------------------------------------------------------


def _split_input(fx: Fixtures) -> DataFrame:
    """Sends with the contact of their order and, for one brand of priority, a channel name."""
    contact = fx.queue_detail().select(
        F.col("emailqueueid").alias("email_id"), "redpointcontactid"
    )
    channel = F.when(F.col("isccode") == "1-URGENT", "a control group").when(
        F.col("isccode") == "2-HIGH", "mail"
    )
    return (
        fx.contact_email()
        .select("email_id", "emailsource_id", "isccode")
        .join(contact, "email_id", "left")
        .withColumn("channel_name", channel)
        .drop("isccode")
    )


@_query("channel_split")
def channel_split_one_pass(fx: Fixtures) -> DataFrame:
    return channel_split(_split_input(fx), MASS_MAILER_IN_SENDS)


@_query("channel_split_union")
def channel_split_two_branches(fx: Fixtures) -> DataFrame:
    return channel_split_union(_split_input(fx), MASS_MAILER_IN_SENDS)


def _send_fact_ocp(fx: Fixtures, dates: ResponseDates, keep: Keep = as_planned) -> DataFrame:
    return plans.send_fact_ocp(
        keep("sends", _clean_sends(fx)),
        fx.queue_detail(),
        fx.queue_success(),
        fx.template(),
        fx.shopper(),
        start=dates.send_start,
        queue_start=dates.queue_start,
        end=dates.end,
        build_ts=BUILD_TS,
    )


@_query("send_fact_ocp")
def send_fact_ocp(fx: Fixtures) -> DataFrame:
    return _send_fact_ocp(fx, OCP_DATES)


@_query("send_fact_ocp_window")
def send_fact_ocp_window(fx: Fixtures) -> DataFrame:
    """Two starts and an end that cut."""
    return _send_fact_ocp(fx, WINDOW_DATES)


def _keyed_opens(fx: Fixtures) -> DataFrame:
    return with_email_keys(
        _clean_opens(fx).select(
            "email_open_id", "open_mst_ts", "shopper_id", "message_id", "isc_code", "template_id"
        )
    )


def _opened(joined: DataFrame) -> DataFrame:
    return joined.select(
        "email_open_id",
        "open_mst_ts",
        "shopper_id",
        "message_id",
        "email_id",
        "sent_mst_ts",
        "emailsource_id",
        "shopper_email_domain_name",
    )


@_query("norm_join_open_send")
def norm_join_open_send(fx: Fixtures) -> DataFrame:
    return _opened(open_sends(_keyed_opens(fx), with_email_keys(_clean_sends(fx))))


@_query("bucketed_open_send")
def bucketed_open_send(fx: Fixtures) -> DataFrame:
    """The same with sends that are stored in buckets of the normalised keys."""
    table = f"bucketed_sends_{uuid4().hex}"
    sends = with_email_keys(_clean_sends(fx))
    write_bucketed(sends, table, _scratch(fx, table), SEND_KEYS, BUCKETS)
    return _opened(open_sends_bucketed(_keyed_opens(fx), fx.spark.table(table)))


@_query("open_queue_fanout")
def open_queue_fanout(fx: Fixtures) -> DataFrame:
    opens = with_email_keys(_clean_opens(fx))
    return open_queue(opens, _queue_stage(fx)).select(
        "email_open_id", "open_mst_ts", "message_id", "redpointcontactid"
    )


@_query("attribution_counts")
def attribution_counts(fx: Fixtures) -> DataFrame:
    """Rows before and after the joins of opens with sends and queue rows, told by the job that writes them."""
    counts = Counts()
    opened = open_attribution(_clean_opens(fx), _clean_sends(fx), _queue_stage(fx), counts)
    opened.write.parquet(_scratch(fx, "attributed_opens"))
    return fx.spark.createDataFrame(list(counts.rows().items()), "point string, rows bigint")


@_query("click_chain")
def click_chain(fx: Fixtures) -> DataFrame:
    """In steps: the clean sends, the stage and the tracked clicks are stored first."""
    keep = Steps("click_chain")
    clicks = tracked_clicks(
        scans.click_tracking(fx.click_tracking()),
        scans.success_tracking(fx.success_tracking()),
        scans.queue_success_ids(fx.queue_success()),
    )
    sources = keep("tracked", clicks), keep("stage", _queue_stage(fx)), keep("sends", _clean_sends(fx))
    return keep.only(click_attribution(*sources, keep=keep), "tracked", "sends", "queued")


@_query("click_lookup")
def click_lookup(fx: Fixtures) -> DataFrame:
    """The tracked clicks of a few days, with links and queue rows stored for look-ups and found by them."""
    tracking, success = (_scratch(fx, name) for name in ("click_links", "click_queue"))
    write_for_lookups(fx.success_tracking(), tracking, "trackingcode")
    write_for_lookups(fx.queue_success(), success, "emailqueuesuccessid")
    clicks = scans.click_tracking(fx.click_tracking())
    stored = fx.spark.read.parquet
    return tracked_clicks_looked_up(
        clicks.where(Bounds(LOOKUP_FROM, LOOKUP_TO).within(clicks, "email_response_mst_ts")),
        scans.success_tracking(stored(tracking)),
        scans.queue_success_ids(stored(success)),
    )


def _ocp_sources(fx: Fixtures, keep: Keep = as_planned) -> list[DataFrame]:
    """The clean tables, each a step where ``keep`` stores them, and the tracking tables."""
    return [
        keep("sends", _clean_sends(fx)),
        keep("opens", _clean_opens(fx)),
        keep("stage", _queue_stage(fx)),
        fx.queue_success(),
        fx.success_tracking(),
        fx.click_tracking(),
    ]


@_query("response_union")
def response_union(fx: Fixtures) -> DataFrame:
    keep = Steps("response_union")
    return keep.only(ocp_responses(*_ocp_sources(fx, keep), OCP_DATES, keep=keep), *ATTRIBUTED)


@_query("content_hierarchy")
def content_blocks(fx: Fixtures) -> DataFrame:
    hierarchy = content_hierarchy(
        scans.block_keys(fx.block_keys()),
        scans.block_subcategories(fx.block_subcategories()),
        scans.block_categories(fx.block_categories()),
    )
    tracking = scans.success_tracking(fx.success_tracking())
    return add_content(tracking, hierarchy).select(
        "trackingcode",
        "content_block_key_id",
        "content_block_key_name",
        "content_block_subcategory_id",
        "content_block_subcategory_name",
        "content_block_category_id",
        "content_block_category_name",
    )


def _response_fact_ocp(
    fx: Fixtures, keep: Steps, dates: ResponseDates = OCP_DATES
) -> DataFrame:
    fact = plans.response_fact_ocp(
        *_ocp_sources(fx, keep),
        fx.template(),
        fx.block_keys(),
        fx.block_subcategories(),
        fx.block_categories(),
        fx.shopper(),
        dates=dates,
        build_ts=BUILD_TS,
        keep=keep,
    )
    return keep.only(fact, *ATTRIBUTED)


def _stored_response_fact_ocp(fx: Fixtures, keep: Steps) -> DataFrame:
    """The response fact as a last step, for jobs that go on with it."""
    return keep.only(keep("fact", _response_fact_ocp(fx, keep)), "fact")


@_query("response_fact_ocp")
def response_fact_ocp(fx: Fixtures) -> DataFrame:
    return _response_fact_ocp(fx, Steps("response_fact_ocp"))


@_query("response_fact_ocp_window")
def response_fact_ocp_window(fx: Fixtures) -> DataFrame:
    """All six dates differ and cut."""
    return _response_fact_ocp(fx, Steps("response_fact_ocp_window"), WINDOW_DATES)


@_query("flagged_response_fact_ocp")
def flagged_response_fact_ocp(fx: Fixtures) -> DataFrame:
    """The response fact with its flags, as the flag job leaves it."""
    fact = _stored_response_fact_ocp(fx, Steps("flagged_response_fact_ocp"))
    return plans.flag_first_response(fact, FIRST_DAY, FIRST_DAY, END_DAY)


# --- SFMC world -----------------------------------------------------------------------------


@_query("conform_events")
def conformed_events(fx: Fixtures) -> DataFrame:
    return conform_events(
        fx.sfmc_events(), Bounds(EVENTS_FIRST_DAY, RESPONSES_END_DAY), EVENTS_END_DAY
    )


@_query("conform_events_window")
def conform_events_window(fx: Fixtures) -> DataFrame:
    """A response window within the events, and bounces up to the later end of the run."""
    window = Bounds(WINDOW_FIRST_TS, WINDOW_END_TS)
    return conform_events(fx.sfmc_events(), window, WINDOW_RUN_END_TS)


@_query("sfmc_send_prune")
def sfmc_send_prune(fx: Fixtures) -> DataFrame:
    """Sends of March that are stored under February of their year."""
    moved = fx.sfmc_sent().withColumns(
        {
            "event_utc_ts": F.col("event_utc_ts") + F.make_dt_interval(days=F.lit(MOVED_DAYS)),
            "month": F.lit(STORED_MONTH),
        }
    )
    return sent_in_range(scans.sfmc_sent(moved), Bounds(MOVED_FROM, MOVED_TO))


@_query("sfmc_send_log_join")
def sfmc_send_log_join(fx: Fixtures) -> DataFrame:
    bounds = Bounds(EVENTS_FIRST_DAY, EVENTS_END_DAY)
    return join_send_log(
        sent_in_range(scans.sfmc_sent(fx.sfmc_sent()), bounds),
        log_in_range(scans.sfmc_send_log(fx.sfmc_send_log()), bounds),
    )


@_query("exclusion_flag")
def exclusion_flag(fx: Fixtures) -> DataFrame:
    """The list goes through a headed text file, as it comes in practice."""
    path = _scratch(fx, "exclusion_list")
    fx.exclusion_list().write.csv(path, header=True)
    orders = fx.table("orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer_id")
    )
    return flag_excluded(orders, scans.exclusion_csv(fx.spark, path))


@_query("latest_build")
def latest_customer_build(fx: Fixtures) -> DataFrame:
    return scans.customers(latest_build(fx.customer_ids())).distinct()


@_query("latest_build_null")
def latest_build_beside_null(fx: Fixtures) -> DataFrame:
    """From a stored table that has a null build besides: rows of an unknown build are never the newest."""
    path = _scratch(fx, "customer_builds")
    unknown = fx.customer_ids().withColumn("build_ts", F.lit(None).cast("string"))
    fx.customer_ids().unionByName(unknown).write.partitionBy("build_ts").parquet(path)
    schema = fx.customer_ids().schema
    stored = fx.spark.read.schema(schema).parquet(path)
    return scans.customers(latest_build(stored)).distinct()


def _order_texts(fx: Fixtures) -> DataFrame:
    """Orders as text, in which some prices and dates are malformed or missing."""
    key = F.col("o_orderkey")
    price, day = (F.col(c).cast("string") for c in ("o_custkey", "o_orderdate"))
    return fx.table("orders").select(
        key.cast("string").alias("order_id"),
        F.when(key % 7 == 0, F.concat(price, F.lit(" USD"))).when(key % 5 == 0, None).otherwise(price).alias("customer"),
        F.when(key % 11 == 0, F.lit("no day")).otherwise(F.substring(day, 1, 10)).alias("day"),
    )


@_query("tolerant_casts")
def tolerant_casts(fx: Fixtures) -> DataFrame:
    """Good rows and rejects with their reasons, from one pass."""
    marked = cast_with_rejects(_order_texts(fx), {"order_id": "int", "customer": "bigint", "day": "date"})
    return marked.withColumn("day", F.col("day").cast("string"))


@_query("csv_rejects")
def csv_rejects(fx: Fixtures) -> DataFrame:
    """The same rows through a headed text file, read in a typed schema: the rejected lines."""
    path = _scratch(fx, "order_texts")
    _order_texts(fx).write.option("emptyValue", "").csv(path, header=True)
    kinds = StructType.fromDDL("order_id int, customer bigint, day date")
    rejected = rejected_rows(csv_with_rejects(fx.spark, path, kinds))
    return rejected.select("order_id", "reject_record", "reject_reason")


def _send_fact_sfmc(fx: Fixtures) -> DataFrame:
    return plans.send_fact_sfmc(
        fx.sfmc_sent(),
        fx.sfmc_send_log(),
        fx.exclusion_list(),
        latest_build(fx.customer_ids()),
        fx.shopper(),
        start=EVENTS_FIRST_DAY,
        end=EVENTS_END_DAY,
        build_ts=BUILD_TS,
    )


def _response_fact_sfmc(fx: Fixtures) -> DataFrame:
    return plans.response_fact_sfmc(
        fx.sfmc_events(),
        fx.sfmc_sent(),
        fx.sfmc_send_log(),
        fx.exclusion_list(),
        latest_build(fx.customer_ids()),
        fx.shopper(),
        open_start=EVENTS_FIRST_DAY,
        open_end=RESPONSES_END_DAY,
        send_start=EVENTS_FIRST_DAY,
        end=EVENTS_END_DAY,
        build_ts=BUILD_TS,
    )


@_query("send_fact_sfmc")
def send_fact_sfmc(fx: Fixtures) -> DataFrame:
    return _send_fact_sfmc(fx)


@_query("response_fact_sfmc")
def response_fact_sfmc(fx: Fixtures) -> DataFrame:
    return _response_fact_sfmc(fx)


# --- Dimensions -----------------------------------------------------------------------------


def _dim_campaign(fx: Fixtures) -> DataFrame:
    return plans.dim_campaign(
        fx.metadata_campaigns(),
        fx.metadata_channels(),
        fx.metadata_utms(),
        fx.metadata_segments(),
        BUILD_TS,
    )


def _dim_template(fx: Fixtures) -> DataFrame:
    return plans.dim_template(fx.template_metadata(), BUILD_TS)


def _dim_holdout(fx: Fixtures) -> DataFrame:
    return plans.dim_holdout(
        fx.holdout(), latest_build(fx.customer_ids()), *SNAPSHOT, build_ts=BUILD_TS
    )


@_query("dim_campaign")
def dim_campaign(fx: Fixtures) -> DataFrame:
    return _dim_campaign(fx)


@_query("dim_template_latest")
def dim_template_latest(fx: Fixtures) -> DataFrame:
    return _dim_template(fx)


@_query("dim_holdout")
def dim_holdout(fx: Fixtures) -> DataFrame:
    return _dim_holdout(fx)


# --- Sink -----------------------------------------------------------------------------------

Target = tuple[StructType, list[str]]
# Name, how it is built, schema and partitions of the tables that are written as they are built.
_TARGETS: dict[str, tuple[Callable[[Fixtures], DataFrame], Target]] = {
    "clean_sends": (_clean_sends, (schemas.CLEAN_SENDS, schemas.CLEAN_SENDS_PARTITIONS)),
    "clean_opens": (_clean_opens, (schemas.CLEAN_OPENS, schemas.CLEAN_OPENS_PARTITIONS)),
    "queue_stage": (_queue_stage, (schemas.QUEUE_STAGE, schemas.QUEUE_STAGE_PARTITIONS)),
    "send_fact_ocp": (
        lambda fx: _send_fact_ocp(fx, OCP_DATES),
        (schemas.SEND_FACT, schemas.SEND_FACT_PARTITIONS),
    ),
    "send_fact_sfmc": (
        _send_fact_sfmc,
        (schemas.SEND_FACT, schemas.SEND_FACT_PARTITIONS),
    ),
    "response_fact_sfmc": (
        _response_fact_sfmc,
        (schemas.RESPONSE_FACT, schemas.RESPONSE_FACT_PARTITIONS),
    ),
    "dim_campaign": (_dim_campaign, (schemas.CAMPAIGN_DIM, schemas.CAMPAIGN_DIM_PARTITIONS)),
    "dim_template_latest": (_dim_template, (schemas.TEMPLATE_DIM, schemas.TEMPLATE_DIM_PARTITIONS)),
    "dim_holdout": (_dim_holdout, (schemas.HOLDOUT_DIM, schemas.HOLDOUT_DIM_PARTITIONS)),
}

# How the whole of a table is built whose shuffles, of its joins and of its write, are too much at once.
_IN_STEPS: dict[str, Callable[[Fixtures, Keep], DataFrame]] = {
    "send_fact_ocp": lambda fx, keep: keep("fact", _send_fact_ocp(fx, OCP_DATES, keep)),
}


def _stored_twice(fx: Fixtures, name: str) -> DataFrame:
    """The table ``name``, written by its days, the last days a second time in place of the first, and read
    back. The tables are written while the query is built and stay in the scratch folder."""
    build, (schema, partitions) = _TARGETS[name]
    path = _scratch(fx, f"{name}_sink")
    keep = Steps(f"{name}_sink")
    whole = _IN_STEPS[name](fx, keep) if name in _IN_STEPS else build(fx)
    add_run(keep.only(whole, "fact"), path, schema, partitions, "1")
    keep.only(whole)
    add_run(build(fx).where(F.col(partitions[0]) >= FLAG_FROM), path, schema, partitions, "2")
    return read_newest(fx.spark, path, schema, partitions)


def _sink_query(name: str) -> None:
    @_query(f"{name}_sink")
    def run(fx: Fixtures) -> DataFrame:
        return _stored_twice(fx, name)


for _name in _TARGETS:
    _sink_query(_name)


@_query("response_fact_ocp_sink")
def response_fact_ocp_sink(fx: Fixtures) -> DataFrame:
    """The response fact through its table and the flag job, which reads that table and adds all its days
    to it again. In steps: both are whole before they are dealt out to their days."""
    target = schemas.RESPONSE_FACT, schemas.RESPONSE_FACT_PARTITIONS
    path = _scratch(fx, "response_fact_ocp_sink")
    keep = Steps("response_fact_ocp_sink")
    add_run(_stored_response_fact_ocp(fx, keep), path, *target, run="1")
    stored = keep.only(read_newest(fx.spark, path, *target))
    flagged = keep("flagged", plans.flag_first_response(stored, FIRST_DAY, FIRST_DAY, END_DAY))
    add_run(flagged, path, *target, run="2")
    keep.only(flagged)
    return read_newest(fx.spark, path, *target)


def _order_rows(fx: Fixtures) -> tuple[DataFrame, StructType, list[str]]:
    """Orders as a small table by year and status."""
    orders = fx.table("orders").select(
        F.col("o_orderkey").cast("string").alias("email_send_id"),
        F.col("o_orderdate").alias("email_send_mst_ts"),
        F.lit("first").alias("template_name"),
        F.year("o_orderdate").cast("string").alias("email_send_mst_date"),
        F.col("o_orderstatus").alias("email_source_system_name"),
    )
    schema = StructType([field for field in SEND_FACT if field.name in orders.columns])
    return orders, schema, ["email_send_mst_date", "email_source_system_name"]


def _early_again(stored: DataFrame, name: str) -> DataFrame:
    early = stored.where(F.col("email_send_mst_date") <= "1997")
    return early.withColumn("template_name", F.lit(name))


@_query("versioned_partitions")
def versioned_partitions(fx: Fixtures) -> DataFrame:
    """Three runs: all orders, the years up to 1997 anew from the stored table, with 1992 emptied, and one
    that is killed before it is finished. The state after the first run is read too."""
    orders, schema, partitions = _order_rows(fx)
    path = _scratch(fx, "versioned_partitions")
    target = path, schema, partitions
    add_run(orders, *target, run="1")
    again = _early_again(read_newest(fx.spark, *target), "second")
    first_year = F.col("email_send_mst_date") == "1992"
    gone = orders.where(first_year).select(*partitions).distinct()
    add_run(again.where(~first_year), *target, run="2", emptied=gone)
    write_partitioned(_early_again(orders, "killed"), f"{path}/data/run=3", partitions, "overwrite")
    now, before = read_newest(fx.spark, *target), read_newest(fx.spark, *target, as_of="1")
    return now.withColumn("state", F.lit("newest")).unionByName(
        before.withColumn("state", F.lit("run 1"))
    )


@_query("insert_overwrite_partitions")
def insert_overwrite_partitions(fx: Fixtures) -> DataFrame:
    """Writes all orders by year and status, then rewrites the years up to 1997.

    The second write reads the table it overwrites, and leaves the other partitions alone.
    """
    path = _scratch(fx, "insert_overwrite_partitions")
    orders, schema, partitions = _order_rows(fx)
    replace_partitions(orders, path, schema, partitions)
    again = _early_again(read_table(fx.spark, path, schema), "second")
    replace_partitions(again, path, schema, partitions)
    return read_table(fx.spark, path, schema)
