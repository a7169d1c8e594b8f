"""Replacing partitions of stored tables."""

from importlib import import_module

import pytest
from helpers import at, frame, rows
from pyspark.sql import functions as F

from mailfacts import plans
from mailfacts.session import scratch_dir
from mailfacts.sources import schemas
from mailfacts.sources.sink import (
    create_table,
    read_table,
    replace_partitions,
    replace_table_partitions,
)

SCHEMA = schemas.TEMPLATE_DIM
PARTITIONS = schemas.TEMPLATE_DIM_PARTITIONS


def dim(spark, *data):
    """(email id, name, partition)"""
    full = [(email, name, None, None, at("2024-01-01"), day) for email, name, day in data]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "dim")


def stored(spark, path):
    return rows(
        read_table(spark, path, SCHEMA), "email_id", "email_name", "etl_build_mst_date"
    )


def test_other_partitions_stay(spark, path):
    replace_partitions(
        dim(spark, ("1", "a", "d1"), ("2", "b", "d1"), ("3", "c", "d2")), path, SCHEMA, PARTITIONS
    )
    replace_partitions(dim(spark, ("1", "z", "d1")), path, SCHEMA, PARTITIONS)
    assert stored(spark, path) == {("1", "z", "d1"): 1, ("3", "c", "d2"): 1}


def test_an_empty_result_replaces_nothing(spark, path):
    replace_partitions(dim(spark, ("1", "a", "d1")), path, SCHEMA, PARTITIONS)
    replace_partitions(dim(spark).where("false"), path, SCHEMA, PARTITIONS)
    assert stored(spark, path) == {("1", "a", "d1"): 1}


def test_repeating_a_run_changes_nothing(spark, path):
    df = dim(spark, ("1", "a", "d1"), ("2", "b", "d2"))
    for _ in range(2):
        replace_partitions(df, path, SCHEMA, PARTITIONS)
        assert stored(spark, path) == {("1", "a", "d1"): 1, ("2", "b", "d2"): 1}


def test_a_table_can_be_rewritten_from_itself(spark, path):
    replace_partitions(dim(spark, ("1", "a", "d1"), ("2", "b", "d2")), path, SCHEMA, PARTITIONS)
    table = read_table(spark, path, SCHEMA)
    again = table.where("etl_build_mst_date = 'd1'").withColumn("email_name", F.lit("z"))
    replace_partitions(again, path, SCHEMA, PARTITIONS)
    assert stored(spark, path) == {("1", "z", "d1"): 1, ("2", "b", "d2"): 1}


def test_columns_are_placed_by_name(spark, path):
    df = dim(spark, ("1", "a", "d1"))
    replace_partitions(df.select(*reversed(df.columns)), path, SCHEMA, PARTITIONS)
    assert stored(spark, path) == {("1", "a", "d1"): 1}


def test_a_large_partition_is_written_by_several_tasks(spark, path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB")
    big = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("email_id"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMA
          if f.name not in ("email_id", "etl_build_mst_date")),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("d"), F.col("id") % 30)).otherwise("hot").alias(
            "etl_build_mst_date"
        ),
    )
    replace_partitions(big, path, SCHEMA, PARTITIONS)
    files = read_table(spark, path, SCHEMA).inputFiles()
    assert sum("etl_build_mst_date=hot" in name for name in files) > 1
    small = [name for name in files if "etl_build_mst_date=hot" not in name]
    assert len(small) < 10 * 8  # days times tasks, had every task written every day


@pytest.fixture
def table(spark):
    name = "test_template_dim"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, SCHEMA, PARTITIONS)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_catalog_table(spark, table):
    columns = ("email_id", "email_name", "etl_build_mst_date")
    first = dim(spark, ("1", "a", "d1"), ("2", "b", "d2"))
    replace_table_partitions(first.select(*reversed(first.columns)), table, SCHEMA, PARTITIONS)
    create_table(spark, table, SCHEMA, PARTITIONS)  # exists already: nothing happens
    again = spark.table(table).where("etl_build_mst_date = 'd1'").withColumn(
        "email_name", F.lit("z")
    )
    replace_table_partitions(again, table, SCHEMA, PARTITIONS)
    assert rows(spark.table(table), *columns) == {("1", "z", "d1"): 1, ("2", "b", "d2"): 1}


def test_catalog_table_refuses_static_mode(spark, table, settings):
    settings(spark__sql__sources__partitionOverwriteMode="static")
    with pytest.raises(ValueError, match="dynamic"):
        replace_table_partitions(dim(spark), table, SCHEMA, PARTITIONS)


def test_flag_job_keeps_sfmc_partitions(spark, tmp_path):
    path = str(tmp_path / "responses")
    keep = ("email_send_id", "email_response_type", "email_response_code",
            "email_response_mst_ts", "email_response_mst_date", "email_source_system_name")
    some = frame(
        spark,
        "email_send_id string, email_response_type string, email_response_code string,"
        " email_response_mst_ts timestamp_ntz, email_response_mst_date string,"
        " email_source_system_name string",
        ("a", "open", "o", at("2024-01-01"), "2024-01-01", "ocp"),
        ("a", "open", "o", at("2024-01-02"), "2024-01-02", "ocp"),
        ("b", "open", "o", at("2024-01-02"), "2024-01-02", "sfmc"),
    )
    full = some.select(
        *(
            F.col(f.name) if f.name in keep else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.RESPONSE_FACT
        )
    )
    to = (path, schemas.RESPONSE_FACT, schemas.RESPONSE_FACT_PARTITIONS)
    replace_partitions(full, *to)
    for _ in range(2):  # repeating the job changes nothing
        table = read_table(spark, path, schemas.RESPONSE_FACT)
        flagged = plans.flag_first_response(table, "2024-01-02", "2024-01-01", "2024-01-31")
        replace_partitions(flagged, *to)
        got = rows(
            read_table(spark, path, schemas.RESPONSE_FACT),
            "email_send_id",
            "email_response_mst_date",
            "email_source_system_name",
            "first_open_flag",
        )
        assert got == {
            ("a", "2024-01-01", "ocp", None): 1,
            ("a", "2024-01-02", "ocp", False): 1,
            ("b", "2024-01-02", "sfmc", None): 1,
        }


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("name", [
    "clean_sends", "clean_opens", "queue_stage", "send_fact_ocp", "response_fact_ocp",
    "dim_campaign", "dim_template_latest", "dim_holdout",
])
def test_sink_queries_store_whole_days(spark, monkeypatch, name):
    """What each write of a sink query is given; nothing is written. The flag job reads the stored
    response fact before the staging table is written."""
    queries = import_module("mailfacts.catalogue.queries")
    tables, written, steps = {}, [], []

    def write(df, path, schema, partitions):
        tables[path] = df
        steps.append(("write", path))
        written.append(df.select(F.length(partitions[0]).alias("n")))

    def read(spark, path, schema):
        steps.append(("read", path))
        return tables[path]

    monkeypatch.setattr(queries, "replace_partitions", write)
    monkeypatch.setattr(queries, "read_table", read)
    queries.queries()[f"{name}_sink"](spark, "/root/testdata/sf0.001")
    for lengths in written:
        assert {r.n for r in lengths.distinct().collect()} == {10}
    if name == "response_fact_ocp":
        (_, sink), (_, staging) = steps[0], steps[2]
        assert steps == [
            ("write", sink), ("read", sink), ("write", staging),
            ("read", staging), ("write", sink), ("read", sink),
        ]
    else:
        assert [kind for kind, _ in steps] == ["write", "write", "read"]
        assert len(set(tables)) == 1
