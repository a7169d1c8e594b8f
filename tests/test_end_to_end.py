"""All jobs through stored tables, twice."""

from helpers import rows
from pyspark.sql import functions as F

from mailfacts import plans
from mailfacts.operators.builds import latest_build
from mailfacts.plans.responses import ResponseDates
from mailfacts.sources import schemas
from mailfacts.catalogue.fixtures import SNAPSHOT, Fixtures
from mailfacts.sources.sink import read_table, replace_partitions

FOLDER = "/root/testdata/sf0.001"
BUILD = "2024-03-01 00:00:00"
# A short run over a longer history, so that few date partitions are written.
SENT_FROM, OPENED_FROM, END = "1996-01-01", "1996-02-15", "1996-03-01"
EVENTS_FROM, EVENTS_END = "2024-01-10", "2024-01-15"


class Warehouse:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def write(self, name, df):
        schema, partitions = self._layout(name)
        replace_partitions(df, f"{self.root}/{name}", schema, partitions)

    def read(self, name):
        return read_table(self.spark, f"{self.root}/{name}", self._layout(name)[0])

    @staticmethod
    def _layout(name):
        return getattr(schemas, name.upper()), getattr(schemas, f"{name.upper()}_PARTITIONS")


def run_all(fx, store):
    customermap = fx.customermap()
    store.write(
        "clean_sends",
        plans.clean_sends(fx.contact_email(), customermap, SENT_FROM, END, BUILD),
    )
    store.write(
        "clean_opens",
        plans.clean_opens(fx.contact_email_open(), customermap, OPENED_FROM, END, BUILD),
    )
    store.write(
        "queue_stage", plans.queue_stage(fx.queue_detail(), fx.queue_success(), SENT_FROM, END)
    )
    store.write(
        "send_fact",
        plans.send_fact_ocp(
            store.read("clean_sends"),
            fx.queue_detail(),
            fx.queue_success(),
            fx.template(),
            fx.shopper(),
            start=SENT_FROM,
            queue_start=SENT_FROM,
            end=END,
            build_ts=BUILD,
        ),
    )
    store.write(
        "response_fact",
        plans.response_fact_ocp(
            store.read("clean_sends"),
            store.read("clean_opens"),
            store.read("queue_stage"),
            fx.queue_success(),
            fx.success_tracking(),
            fx.click_tracking(),
            fx.template(),
            fx.block_keys(),
            fx.block_subcategories(),
            fx.block_categories(),
            fx.shopper(),
            ResponseDates(OPENED_FROM, END, SENT_FROM, SENT_FROM, SENT_FROM, END),
            BUILD,
        ),
    )
    customers = (fx.exclusion_list(), latest_build(fx.customer_ids()), fx.shopper())
    store.write(
        "send_fact",
        plans.send_fact_sfmc(
            fx.sfmc_sent(), fx.sfmc_send_log(), *customers, EVENTS_FROM, EVENTS_END, BUILD
        ),
    )
    store.write(
        "response_fact",
        plans.response_fact_sfmc(
            fx.sfmc_events(),
            fx.sfmc_sent(),
            fx.sfmc_send_log(),
            *customers,
            open_start=EVENTS_FROM,
            open_end=EVENTS_END,
            send_start=EVENTS_FROM,
            end=EVENTS_END,
            build_ts=BUILD,
        ),
    )
    store.write(
        "response_fact",
        plans.flag_first_response(store.read("response_fact"), "1996-02-20", SENT_FROM, END),
    )
    store.write(
        "campaign_dim",
        plans.dim_campaign(
            fx.metadata_campaigns(),
            fx.metadata_channels(),
            fx.metadata_utms(),
            fx.metadata_segments(),
            BUILD,
        ),
    )
    store.write("template_dim", plans.dim_template(fx.template_metadata(), BUILD))


def test_jobs_through_stored_tables_can_be_repeated(spark, tmp_path):
    fx, store = Fixtures(spark, FOLDER), Warehouse(spark, str(tmp_path))
    run_all(fx, store)
    names = ("send_fact", "response_fact", "campaign_dim", "template_dim")
    first = {name: rows(store.read(name)) for name in names}
    assert all(first.values())

    responses = store.read("response_fact")
    systems = {row[0] for row in responses.select("email_source_system_name").distinct().collect()}
    assert "sfmc" in systems and "ocp" in systems
    own = responses.where("email_source_system_name <> 'sfmc'")
    in_range = F.col("email_response_mst_date") >= "1996-02-20"
    # Flags are set where the job rewrote partitions and nowhere else.
    assert own.where(in_range & F.col("first_open_flag").isNull()).count() == 0
    assert own.where(in_range).count() > 0
    assert own.where(~in_range & F.col("first_open_flag").isNotNull()).count() == 0
    # Responses find their sends by the same surrogate key.
    sends = store.read("send_fact").select("email_send_id").distinct()
    answered = responses.where("email_source_system_name = 'sfmc'").join(
        sends, "email_send_id", "left_semi"
    )
    assert answered.count() > 0

    run_all(fx, store)
    for name in names:
        assert rows(store.read(name)) == first[name], name


def test_holdout_dimension_is_stored_by_snapshot_date(spark, tmp_path):
    fx = Fixtures(spark, FOLDER)
    df = plans.dim_holdout(
        fx.holdout().where(F.col("etl_build_utc_ts") < "1995-02-01"),
        latest_build(fx.customer_ids()),
        *SNAPSHOT,
        build_ts=BUILD,
    )
    store = Warehouse(spark, str(tmp_path))
    store.write("holdout_dim", df)
    assert rows(store.read("holdout_dim")) == rows(df)
