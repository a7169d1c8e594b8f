"""Kept minima, bucketed histories, builds, typed rejects."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import at, count, frame, planned, ran, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mailfacts.functions.time import Bounds
from mailfacts.operators.attribution import SEND_KEYS, open_sends, open_sends_bucketed, with_email_keys
from mailfacts.operators.builds import latest_build, stored_builds
from mailfacts.operators.counts import Counts
from mailfacts.operators.dedupe import latest_per_key, latest_per_key_aggregate
from mailfacts.operators.first_response import DATE, first_response_flags, own_responses
from mailfacts.operators.lookups import looked_up, write_for_lookups
from mailfacts.operators.kept_minima import flag_with_minima, minima_of, smallest_kept
from mailfacts.operators.rejects import cast_with_rejects, csv_with_rejects, good_rows, rejected_rows
from mailfacts.sources.buckets import write_bucketed
from mailfacts.sources.versions import add_run, read_newest

# --- Kept minima --------------------------------------------------------------------------------

RESPONSES = (
    "email_send_id string, email_response_type string, email_response_code string,"
    " email_response_mst_ts timestamp_ntz, email_response_mst_date string,"
    " email_source_system_name string, first_open_flag boolean, first_click_flag boolean,"
    " first_complaint_flag boolean, note string"
)
PARTITIONS = [DATE, "email_source_system_name"]
START = datetime(2024, 1, 1)


def responses(spark, seed, many=400):
    rng = random.Random(seed)
    data = []
    for i in range(many):
        ts = START + timedelta(hours=rng.randrange(24 * 8)) if rng.random() > 0.03 else None
        # A row without a time is still stored under a day.
        day = (ts or START + timedelta(days=rng.randrange(8))).date().isoformat()
        kind = rng.choice(["open", "click", None])
        data.append(
            (
                None if rng.random() < 0.05 else f"s{min(int(rng.expovariate(0.2)), 30)}",
                kind, {"open": "o", "click": "c"}.get(kind, "s"), ts, day,
                rng.choice(["ocp", "ocp", "redpoint", "sfmc", None]), None, None, None, str(i),
            )
        )
    return spark.createDataFrame(data, RESPONSES)


@pytest.mark.parametrize(
    "order",
    [
        [("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-08")],
        [("2024-01-05", "2024-01-08"), ("2024-01-01", "2024-01-04")],
        [("2024-01-03", "2024-01-04"), ("2024-01-07", "2024-01-08"), ("2024-01-01", "2024-01-02"),
         ("2024-01-05", "2024-01-06")],
    ],
)
def test_runs_in_any_order_equal_one_full_run(spark, tmp_path, order):
    whole = responses(spark, 5)
    target = str(tmp_path / "fact"), whole.schema, PARTITIONS
    kept_path = str(tmp_path / "kept")
    kept = minima_of(whole.limit(0))
    for start, end in order:
        add_run(whole.where(Bounds(start, end).within(whole, DATE)), *target)
        run = flag_with_minima(read_newest(spark, *target), kept, start, end)
        add_run(run.rows, *target)
        run.minima.write.mode("append").parquet(kept_path)
        kept = spark.read.schema(kept.schema).parquet(kept_path)
    stored = read_newest(spark, *target)
    full = first_response_flags(whole, "2024-01-01", "2024-01-01", "2024-01-08")
    assert rows(own_responses(stored)) == rows(full)
    # SFMC rows and those of no known system keep what is stored.
    others = stored.where("coalesce(email_source_system_name, 'sfmc') = 'sfmc'")
    assert others.count() > 0 and others.where("first_open_flag is not null").count() == 0
    assert rows(smallest_kept(kept)) == rows(minima_of(whole))


def test_a_run_reads_neither_the_history_nor_unconcerned_days(spark, tmp_path):
    whole = responses(spark, 6)
    target = str(tmp_path / "fact"), whole.schema, PARTITIONS
    add_run(whole, *target)
    stored = read_newest(spark, *target)
    early = stored.where(F.col(DATE) < "2024-01-07")
    run = flag_with_minima(stored, minima_of(early), "2024-01-07", "2024-01-08")
    found, plan = ran(run.rows)
    assert {row[DATE] for row in found} == {"2024-01-07", "2024-01-08"}, "nothing came late"
    assert run.minima.where("_first_day < '2024-01-07'").count() == 0


# --- Buckets ------------------------------------------------------------------------------------

SENDS = "shopper_id string, message_id string, isc_code string, template_id string, email_id string,"
SENT = " customermap_id string, sent_mst_ts timestamp_ntz, emailsourcekey string, emailsource_id int, shopper_email_domain_name string"  # noqa: E501


def sends_and_opens(spark):
    rng = random.Random(3)

    def keys():
        hot = rng.random() < 0.3
        return tuple(
            " A " if hot else rng.choice([None, f"{c}{rng.randrange(4)}", f" {c.upper()}{rng.randrange(4)}"])
            for c in "smit"
        )

    sends = [
        (*keys(), str(i), "c", at("2024-01-01") + timedelta(minutes=rng.randrange(50)), "k", 7, "d")
        for i in range(600)
    ]
    opens = [(*keys(), str(i)) for i in range(400)]
    return (
        with_email_keys(spark.createDataFrame(sends, SENDS + SENT)),
        with_email_keys(spark.createDataFrame(opens, SENDS.replace("email_id", "open_id").rstrip(","))),
    )


def test_bucketed_sends_are_joined_without_moving_them(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    sends, opens = sends_and_opens(spark)
    spark.sql("DROP TABLE IF EXISTS test_bucketed_sends")
    write_bucketed(sends, "test_bucketed_sends", str(tmp_path / "sends"), SEND_KEYS, 8)
    stored = spark.table("test_bucketed_sends")
    columns = ["open_id", "email_id", "sent_mst_ts"]
    joined = open_sends_bucketed(opens, stored).select(columns)
    assert rows(joined) == rows(open_sends(opens, sends).select(columns))
    # The history is cut and deduplicated in place: up to the window there is no exchange above its scan.
    lines = planned(joined).splitlines()
    scan = next(i for i, line in enumerate(lines) if "test_bucketed_sends" in line and "Scan" in line)
    indent = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above, level = [], indent(lines[scan])
    for line in reversed(lines[:scan]):
        if indent(line) < level:
            level = indent(line)
            above.append(line)
    window = next(i for i, line in enumerate(above) if " Window " in line)
    assert not any("Exchange" in line for line in above[:window])
    assert any("Join" in line for line in above[:window]), "the cut is below the window"
    spark.sql("DROP TABLE test_bucketed_sends")


def test_the_aggregate_keeps_the_same_rows_as_the_window(spark):
    rng = random.Random(4)
    values = [None, 1, 2, 3]
    data = [tuple(rng.choice(values) for _ in range(5)) for _ in range(3_000)]
    df = frame(spark, "k int, l int, a int, b int, c int", *data)
    for keys in (["k", "l"], ["k"]):
        for by in (["a", "b"], ["b"], ["a"]):
            window, aggregate = (f(df, keys, by) for f in (latest_per_key, latest_per_key_aggregate))
            assert rows(aggregate) == rows(window)


# --- Builds -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("string", ["2024-01-01 00:00+1", "2024-02-01 00:00+1"]),
        ("date", ["2024-01-01", "2024-02-01"]),
        ("int", ["9", "10"]),
        ("timestamp", ["2024-01-01 00:00:00", "2024-02-01 12:30:00"]),
    ],
)
def test_a_null_build_is_never_the_newest(spark, tmp_path, kind, values):
    data = [(1, values[0]), (2, values[1]), (3, None)]
    builds = frame(spark, "id int, build_ts string", *data).withColumn("build_ts", F.col("build_ts").cast(kind))
    path = str(tmp_path / "builds")
    builds.write.partitionBy("build_ts").parquet(path)
    stored = spark.read.schema(builds.schema).parquet(path)
    assert rows(stored_builds(stored, "build_ts")) == rows(builds.where("build_ts is not null").select("build_ts"))
    for table in (stored, builds):
        assert rows(latest_build(table).select("id")) == {(2,): 1}
    assert rows(latest_build(builds.where("build_ts is null"))) == {}
    only_null = str(tmp_path / "null")
    builds.where("build_ts is null").write.partitionBy("build_ts").parquet(only_null)
    assert rows(latest_build(spark.read.schema(builds.schema).parquet(only_null))) == {}


def test_the_newest_build_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "builds")
    frame(spark, "id int, build_ts string", *((i, f"b{i % 5}") for i in range(50))).write.partitionBy(
        "build_ts"
    ).parquet(path)
    found, plan = ran(latest_build(spark.read.parquet(path)))
    assert {row.build_ts for row in found} == {"b4"}
    assert count(r"build_ts#\d+ = b4", plan) >= 1


# --- Rejects ------------------------------------------------------------------------------------


def test_malformed_values_are_named_and_the_rest_kept(spark):
    df = frame(
        spark, "id string, n string, day string",
        ("1", "5", "2024-01-31"), ("2", None, None), ("3", "x", "2024-02-31"), ("4", " 6 ", "2024-01-01"),
    )
    marked = cast_with_rejects(df, {"n": "int", "day": "date"})
    assert [field.simpleString() for field in marked.schema][1:3] == ["n:int", "day:date"]
    assert {row.id: row.n for row in good_rows(marked).collect()} == {"1": 5, "2": None, "4": 6}
    (reject,) = rejected_rows(marked).collect()
    assert (reject.id, reject.n, reject.day) == ("3", None, None)
    assert reject.reject_reason == "n is no int: x; day is no date: 2024-02-31"


def test_malformed_lines_of_a_file(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text('id,day\n1,2024-01-01\nx,2024-01-02\n3\n4,2024-01-04,more\n,\n"6","2024-01-06"\n')
    kinds = StructType.fromDDL("id int, day date")
    marked = csv_with_rejects(spark, str(path), kinds)
    assert rows(good_rows(marked).select("id")) == {(1,): 1, (None,): 1, (6,): 1}
    assert {row.reject_record for row in rejected_rows(marked).collect()} == {"x,2024-01-02", "3", "4,2024-01-04,more"}


# --- Look-ups -----------------------------------------------------------------------------------


def scanned_rows(df):
    """Rows that the scans of a finished query gave on."""
    plan = df._jdf.queryExecution().executedPlan()
    total, queue = 0, [plan]
    while queue:
        node = queue.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            queue.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            queue.append(node.plan())
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return total


def test_few_keys_skip_row_groups(spark, tmp_path):
    rows_in = 40_000
    links = spark.range(rows_in).select(F.sha2(F.col("id").cast("string"), 256).alias("code"), "id").repartition(4)
    path = str(tmp_path / "links")
    # Many small row groups, as a large table has large ones.
    small = {"parquet.block.size": "65536", "parquet.page.size": "8192"}
    write_for_lookups(links, path, "code", group_rows=1_000, **small)
    stored = spark.read.parquet(path)
    wanted = links.where("id in (5, 17, 39999)").select("code")
    found = looked_up(stored, wanted, "code")
    assert {row.id for row in found.collect()} == {5, 17, 39999}
    assert scanned_rows(found) < rows_in / 4
    absent = looked_up(stored, wanted.select(F.concat("code", F.lit("x")).alias("code")), "code")
    assert absent.collect() == [] and scanned_rows(absent) < rows_in / 10
    # More keys than are looked up are joined; the rows are the same.
    assert rows(looked_up(stored, wanted, "code", at_most=2)) == rows(found)


def test_thousands_of_keys_are_looked_up(spark, tmp_path):
    """As many as a list may have, at both ends of the table: the middle is skipped by the single keys only."""
    links = spark.range(40_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("code"), "id").repartition(4)
    path = str(tmp_path / "links")
    small = {"parquet.block.size": "65536", "parquet.page.size": "8192"}
    write_for_lookups(links, path, "code", group_rows=1_000, **small)
    wanted = links.where("id < 5000 or id >= 35000").select("code")
    found = looked_up(spark.read.parquet(path), wanted, "code")
    assert sorted(row.id for row in found.collect()) == [*range(5_000), *range(35_000, 40_000)]
    assert scanned_rows(found) < 20_000


def test_null_keys_are_not_looked_up(spark):
    table = frame(spark, "k string, v int", ("a", 1), (None, 2), ("b", 3))
    for at_most in (0, 10):
        keys = frame(spark, "k string", ("a",), (None,), ("a",))
        assert rows(looked_up(table, keys, "k", at_most)) == {("a", 1): 1}
        assert rows(looked_up(table, keys.limit(0), "k", at_most)) == {}


# --- Counts -------------------------------------------------------------------------------------


def test_counts_come_with_the_job(spark, tmp_path):
    counts = Counts()
    left = counts.at("before", frame(spark, "k int", (1,), (2,), (None,)))
    joined = counts.at("after", left.join(frame(spark, "k int, v int", (1, 1), (1, 2)), "k", "left"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    joined.write.parquet(str(tmp_path / "joined"))
    with_job = len(jobs.getJobIdsForGroup("counted"))
    assert counts.rows() == {"before": 3, "after": 4}
    assert len(jobs.getJobIdsForGroup("counted")) == with_job
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ValueError, match="already"):
        counts.at("after", left)
