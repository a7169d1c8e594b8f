"""The shared test tables presented as the source tables of the plans.

Every source is derived from whole test tables by Spark, so its size follows theirs. Subsets
(queued, opened, held out …) follow a column of the data: a status, a price, an event type.
``catalogue.oracle`` holds the same definitions as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Given with the read, so that opening a table costs no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
    " props string",
}
BUILDS = ("2024-01-01-00", "2024-02-01-00")
SNAPSHOT = ("2024", "02", "01")
OLDER_SNAPSHOT = ("2024", "01", "01")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _shopper() -> Column:
    return F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name"))


def _template_id(order_key: str) -> Column:
    return (F.col(order_key) % 200).cast("int")


def _noted_late() -> Column:
    """None to five days."""
    return F.make_dt_interval(days=F.greatest(F.col("o_orderkey") % 10 - 4, F.lit(0)).cast("int"))


def _label_id(order_key: str) -> Column:
    return (F.col(order_key) % 5).cast("int")


def _locale(number: str) -> Column:
    turn = F.col(number) % 3
    return F.when(turn == 0, "en-US").when(turn == 1, "fr").otherwise("pt-BR")


def _isc() -> Column:
    return F.when(F.col("o_totalprice") < 50000, F.lit("")).otherwise(F.col("o_orderpriority"))


class Fixtures:
    """Source tables over the Parquet test tables in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One test table; opened once, as it is only a plan."""
        if name not in self._tables:
            reader = self.spark.read.schema(TABLES[name])
            self._tables[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- OCP contact tables -----------------------------------------------------------------

    def customermap(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customermap_id"),
            _shopper().alias("shopperid"),
            F.when(
                F.col("c_mktsegment") != "FURNITURE",
                F.concat(F.lower("c_mktsegment"), F.lit(".example")),
            ).alias("emaildomain"),
        )

    def _ordered_lines(self, return_flag: str) -> DataFrame:
        lines = self.table("lineitem").where(F.col("l_returnflag") == return_flag)
        orders = self.table("orders")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])

    def contact_email(self) -> DataFrame:
        """One send per order, and one more per unreturned line: same keys, other spelling."""
        priority = F.col("o_orderpriority")
        source = (
            F.when(priority == "2-HIGH", 8)
            .when(priority == "3-MEDIUM", 13)
            .when(priority == "5-LOW", 99)
            .otherwise(7)
        )
        shared = {
            "customermap_id": F.col("o_custkey"),
            "template_id": _template_id("o_orderkey"),
            "emailsource_id": source,
            "lang": _locale("o_orderkey"),
            "isccode": _isc(),
            "privatelabel_id": _label_id("o_orderkey"),
        }
        first = {
            "email_id": F.col("o_orderkey"),
            "message_id": F.concat(F.lit("M"), _text("o_orderkey")),
            "sentdate": F.col("o_orderdate"),
            "emailsourcekey": F.col("o_orderkey") % 1000,
        }
        again = {
            "email_id": 1000000000 + F.col("l_orderkey") * 8 + F.col("l_linenumber"),
            "message_id": F.concat(
                F.when(F.col("l_linestatus") == "O", "M").otherwise(" m"), _text("l_orderkey")
            ),
            "sentdate": F.col("l_shipdate"),
            "emailsourcekey": F.col("l_partkey") % 1000,
        }
        parts = [
            df.select(*(column.alias(name) for name, column in (own | shared).items()))
            for df, own in ((self.table("orders"), first), (self._ordered_lines("N"), again))
        ]
        return parts[0].unionByName(parts[1])

    def contact_email_open(self) -> DataFrame:
        return self._ordered_lines("A").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("email_open_id"),
            F.concat(F.lit(" m"), _text("l_orderkey")).alias("message_id"),
            F.lower(_isc()).alias("isccode"),
            _template_id("l_orderkey").alias("template_id"),
            F.col("l_shipdate").alias("opendate"),
            _locale("l_orderkey").alias("lang"),
            _label_id("l_orderkey").alias("privatelabel_id"),
            F.col("o_custkey").alias("customermap_id"),
        )

    # --- OCP queue and tracking tables ------------------------------------------------------

    def _queued(self) -> DataFrame:
        """Orders with ``turn`` 0, and again, a day later, with ``turn`` 1: pending ones, which are
        queued for a second contact, and urgent ones, queued twice for the same."""
        again = (F.col("o_orderstatus") == "P") | (F.col("o_orderpriority") == "1-URGENT")
        turns = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (
            self.table("orders")
            .withColumn("turn", F.explode(turns))
            .withColumn("queue_id", F.col("o_orderkey") + F.col("turn") * F.lit(2000000000).cast("long"))
            .withColumn("queued", F.col("o_orderdate") + F.make_dt_interval(days=F.col("turn")))
        )

    def queue_detail(self) -> DataFrame:
        orders, customer = self._queued(), self.table("customer")
        status = F.col("o_orderstatus")
        return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
            F.col("queue_id").alias("emailqueueid"),
            F.concat(F.lit("M"), _text("o_orderkey")).alias("messageguid"),
            F.when(status == "O", F.lit(0))
            .when(status == "P", F.col("o_custkey") + F.col("turn"))
            .alias("redpointcontactid"),
            (F.col("o_totalprice") < 10000).cast("int").alias("isautomatedseedlist"),
            (F.col("o_totalprice") > 490000).cast("int").alias("istestsend"),
            F.col("queued").alias("emailqueuecreatedate"),
            _label_id("o_orderkey").alias("privatelabelid"),
            _shopper().alias("shopperid"),
            status.alias("sourcecode"),
        )

    def queue_success(self) -> DataFrame:
        """Cheap orders failed; half of the others were noted up to five days later."""
        return self._queued().where(F.col("o_totalprice") >= 20000).select(
            F.col("queue_id").alias("emailqueueid"),
            (F.col("queue_id") + 1000000000).alias("emailqueuesuccessid"),
            _template_id("o_orderkey").alias("templateid"),
            (F.col("queued") + _noted_late()).alias("emailqueuecreatedate"),
        )

    def _tracking_code(self) -> Column:
        return F.concat_ws(
            "-", *(_text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
        )

    def success_tracking(self) -> DataFrame:
        return (
            self._ordered_lines("R")
            .select(
                (F.col("l_orderkey") + 1000000000).alias("emailqueuesuccessid"),
                self._tracking_code().alias("trackingcode"),
                F.col("l_suppkey").alias("contentblockkeyid"),
                (F.col("o_orderdate") + _noted_late()).alias("emailqueuecreatedate"),
            )
            .distinct()
        )

    def click_tracking(self) -> DataFrame:
        link = F.when(F.col("l_linenumber") == 1, "other.").otherwise("ocp.email.")
        return (
            self.table("lineitem")
            .where(F.col("l_returnflag") == "R")
            .select(
                self._tracking_code().alias("trackingcode"),
                F.concat(F.lit("k"), self._tracking_code()).alias(
                    "emailqueuesuccesstrackingclickid"
                ),
                F.col("l_shipdate").alias("createdate"),
                F.concat(F.lit("v"), _text("l_partkey")).alias("visitguid"),
                F.concat(F.lit("w"), _text("l_suppkey")).alias("visitorguid"),
                F.concat(link, _text("l_linenumber")).alias("eid"),
            )
        )

    # --- Dimensions -------------------------------------------------------------------------

    def template(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("templateid"), F.col("p_name").alias("templatename")
        )

    def block_keys(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("contentblockkeyid"),
            F.col("s_name").alias("blockkeyname"),
            F.col("s_nationkey").alias("contentblocksubcategoryid"),
        )

    def block_subcategories(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("contentblocksubcategoryid"),
            F.col("n_name").alias("blocksubcategoryname"),
            F.col("n_regionkey").alias("contentblockcategoryid"),
        )

    def block_categories(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("contentblockcategoryid"),
            F.col("r_name").alias("blockcategoryname"),
        )

    def shopper(self) -> DataFrame:
        customer, nation = self.table("customer"), self.table("nation")
        return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
            F.col("c_name").alias("shopper_id"), F.lower("n_name").alias("country")
        )

    # --- SFMC tables ------------------------------------------------------------------------

    def _events(self, event_type: str) -> DataFrame:
        """Events of one type with the SFMC key: day, user group, half of the day, user."""
        return self.table("events").where(F.col("event_type") == event_type).select(
            F.dayofmonth("ts").cast("long").alias("sfmc_job_id"),
            (F.col("user_id") % 3).alias("sfmc_list_id"),
            F.floor(F.hour("ts") / 12).cast("long").alias("sfmc_batch_id"),
            F.col("user_id").alias("sfmc_subscriber_id"),
            F.col("ts").alias("event_utc_ts"),
            F.year("ts").cast("string").alias("year"),
            F.lpad(F.month("ts").cast("string"), 2, "0").alias("month"),
            F.lpad(F.dayofmonth("ts").cast("string"), 2, "0").alias("day"),
            "event_id",
            "value",
            "props",
        )

    def _mailings(self) -> DataFrame:
        """One mailing per key: its earliest purchase."""
        keys = ["sfmc_job_id", "sfmc_list_id", "sfmc_batch_id", "sfmc_subscriber_id"]
        return (
            self._events("purchase")
            .groupBy(*keys, "year", "month", "day")
            .agg(
                F.min("event_utc_ts").alias("event_utc_ts"),
                F.min("event_id").alias("event_id"),
                F.max("value").alias("value"),
            )
        )

    def sfmc_sent(self) -> DataFrame:
        number = _text("event_id")
        return self._mailings().select(
            "sfmc_job_id",
            "sfmc_list_id",
            "sfmc_batch_id",
            "sfmc_subscriber_id",
            "event_utc_ts",
            F.concat(F.lit("mail "), number).alias("email_template_name"),
            number.alias("email_template_id"),
            "year",
            "month",
            "day",
        )

    def sfmc_send_log(self) -> DataFrame:
        """Small purchases left no log entry."""
        user = F.col("sfmc_subscriber_id")
        return self._mailings().where(F.col("value") >= 5).select(
            "sfmc_job_id",
            "sfmc_list_id",
            "sfmc_batch_id",
            "sfmc_subscriber_id",
            _locale("event_id").alias("locale_code"),
            "event_utc_ts",
            user.cast("string").alias("customer_id"),
            F.concat(F.lit("isc"), (user % 7).cast("string")).alias("internal_source_code"),
            (user % 50).cast("int").alias("cms_omni_campaign_id"),
            (user % 20).cast("int").alias("cms_omni_segment_id"),
            (user % 10).cast("int").alias("cms_omni_channel_id"),
            (user % 5).cast("int").alias("private_label_id"),
            "year",
            "month",
            "day",
        )

    def sfmc_events(self) -> dict[str, DataFrame]:
        """The five response tables."""
        value = F.col("value")
        unique = (value >= 50).alias("event_unique_flag")
        number = _text("event_id")
        category = (
            F.when(value < 10, "Soft bounce")
            .when(value < 30, "Hard Bounce")
            .when(value < 60, "Technical/Other bounce")
            .otherwise("Unknown")
        )

        def typed(event_type: str, code: str) -> DataFrame:
            return self._events(event_type).withColumn("event_type_code", F.lit(code))

        signups = self._events("signup")
        return {
            "open": typed("view", "Open").select("*", unique),
            "bounce": self._events("error").withColumn("bounce_category", category),
            "click": typed("click", "Click").select(
                "*",
                unique,
                F.concat(F.lit("https://shop.example/"), number).alias("url"),
                F.concat(F.lit("link "), number).alias("link_name"),
                F.col("props").alias("link_content"),
            ),
            "spam": signups.where(value < 10).withColumn("event_type_code", F.lit("Spam")),
            "unsubscribe": signups.where(value >= 10).withColumn(
                "event_type_code", F.lit("Unsubscribe")
            ),
        }

    def exclusion_list(self) -> DataFrame:
        """Customers with little or negative credit; the latter are listed twice."""
        customer = self.table("customer")
        balance = F.col("c_acctbal")
        listed = customer.where(balance < 2000).unionByName(customer.where(balance < 0))
        return listed.select(_text("c_custkey").alias("QaCustomerID"))

    def customer_ids(self) -> DataFrame:
        """Two builds of the customer table; the older one has other shoppers."""
        customer = self.table("customer").select(
            "c_name", "c_custkey", F.explode(F.array(*map(F.lit, BUILDS))).alias("build_ts")
        )
        old = F.col("build_ts") == BUILDS[0]
        return customer.select(
            F.when(old, F.concat(F.lit("old "), "c_name")).otherwise(F.col("c_name")).alias("id"),
            _text("c_custkey").alias("customerid"),
            "build_ts",
        )

    # --- Metadata ---------------------------------------------------------------------------

    def holdout(self) -> DataFrame:
        """Two snapshots: pending orders were taken in the older one."""
        older = F.col("o_orderstatus") == "P"
        parts = [
            F.when(older, old).otherwise(new) for old, new in zip(OLDER_SNAPSHOT, SNAPSHOT)
        ]
        return self.table("orders").select(
            _text("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("etl_build_utc_ts"),
            (F.col("o_orderkey") % 10).cast("int").alias("cms_omni_channel_id"),
            _locale("o_orderkey").alias("locale_code"),
            F.col("o_orderpriority").alias("internal_source_code"),
            *(part.alias(name) for part, name in zip(parts, ("year", "month", "day"))),
        )

    def _stored_daily(self, df: DataFrame) -> DataFrame:
        """The same rows, stored on two days."""
        days = F.array(*(F.struct(*(F.lit(p).alias(n) for p, n in zip(day, ("year", "month", "day")))) for day in (OLDER_SNAPSHOT, SNAPSHOT)))
        return df.withColumn("stored", F.explode(days)).select("*", "stored.*").drop("stored")

    def metadata_campaigns(self) -> DataFrame:
        name = F.col("r_name")
        return self._stored_daily(self.table("region")).select(
            "year",
            "month",
            "day",
            F.concat(F.lit("objective "), name).alias("objective_name"),
            F.concat(F.lit("subobjective "), name).alias("subobjective_name"),
            F.concat(F.lit("category "), name).alias("category_name"),
            F.concat(F.lit("subcategory "), name).alias("subcategory_name"),
            name.alias("campaign_name"),
            F.lower(name).alias("friendly_name"),
            F.concat(F.lit("class "), name).alias("campaign_classification_name"),
            F.concat(F.lit("group "), name).alias("campaign_group_name"),
            F.col("r_regionkey").alias("cms_omni_campaign_id"),
        )

    def metadata_channels(self) -> DataFrame:
        supplier, nation = self.table("supplier"), self.table("nation")
        name, balance = F.col("s_name"), F.col("s_acctbal")
        supplied = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        return self._stored_daily(supplied).select(
            "year",
            "month",
            "day",
            F.col("n_regionkey").alias("cms_omni_campaign_id"),
            F.col("s_nationkey").alias("cms_omni_segment_id"),
            F.col("s_suppkey").cast("int").alias("cms_omni_channel_id"),
            name.alias("channel_name"),
            F.concat(F.lit("isc "), name).alias("internal_source_code"),
            F.when(balance < 0, "opted out").otherwise("opted in").alias(
                "email_optin_status_name"
            ),
            (balance < 1000).alias("control_flag"),
            (balance < 2000).alias("test_flag"),
            (balance < 3000).alias("three_day_suppression_flag"),
            F.when(balance < 2000, "split").alias("test_type_name"),
            (balance > 5000).alias("international_flag"),
        )

    def metadata_utms(self) -> DataFrame:
        """One row per distinct product and supplier."""
        supplied = self.table("lineitem").select("l_partkey", "l_suppkey").distinct()
        part = self.table("part")
        used = supplied.join(part, supplied["l_partkey"] == part["p_partkey"])
        return self._stored_daily(used).select(
            "year",
            "month",
            "day",
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_content_name"),
            (F.col("p_retailprice") > 1000).alias("revenue_flag"),
            F.col("l_suppkey").cast("int").alias("cms_omni_channel_id"),
        )

    def metadata_segments(self) -> DataFrame:
        name = F.col("n_name")
        return self._stored_daily(self.table("nation")).select(
            "year",
            "month",
            "day",
            name.alias("segment_name"),
            F.concat(F.lit("message "), name).alias("message_classification_name"),
            F.concat(F.lit("trigger "), name).alias("send_type_name"),
            F.col("n_nationkey").alias("cms_omni_segment_id"),
        )

    def template_metadata(self) -> DataFrame:
        """Every part is a version of the template its name stands for."""
        start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        return self.table("part").select(
            F.col("p_name").alias("email_template_id"),
            F.col("p_brand").alias("email_template_name"),
            F.col("p_type").alias("service_ticket_nr"),
            (start + F.make_dt_interval(secs=F.col("p_partkey"))).alias("create_utc_ts"),
        )

    # --- Stored facts -----------------------------------------------------------------------

    def responses(self) -> DataFrame:
        """Events as rows of the response fact (the columns the flags need, and the id)."""
        kind, value = F.col("event_type"), F.col("value")
        code = (
            F.when(kind == "view", "o")
            .when(kind == "click", "c")
            .when(kind == "signup", "s")
            .when(kind == "error", "hb")
        )
        system = F.when(value >= 200, "sfmc").when(value >= 1, "ocp")
        return self.table("events").select(
            F.concat(F.lit("s"), _text("user_id")).alias("email_send_id"),
            _text("event_id").alias("email_id"),
            kind.alias("email_response_type"),
            code.alias("email_response_code"),
            F.col("ts").alias("email_response_mst_ts"),
            F.col("ts").cast("date").cast("string").alias("email_response_mst_date"),
            system.alias("email_source_system_name"),
        )
