"""Tables to which runs only add."""

import re

import pytest
from helpers import at, frame, ran, rows
from pyspark.sql import functions as F

from mailfacts.sources import schemas
from mailfacts.sources.sink import write_partitioned
from mailfacts.sources.versions import add_run, new_run, newest_partitions, read_newest

SCHEMA = schemas.TEMPLATE_DIM
PARTITIONS = schemas.TEMPLATE_DIM_PARTITIONS
DAY = PARTITIONS[0]


def dim(spark, *data):
    """(email id, name, partition)"""
    full = [(email, name, None, None, at("2024-01-01"), day) for email, name, day in data]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "dim"), SCHEMA, PARTITIONS


def stored(spark, target, **options):
    return rows(read_newest(spark, *target, **options), "email_id", "email_name", DAY)


def test_the_newest_run_of_each_partition_counts(spark, target):
    add_run(dim(spark, ("1", "a", "d1"), ("2", "b", "d1"), ("3", "c", "d2")), *target, run="1")
    add_run(dim(spark, ("1", "z", "d1")), *target, run="2")
    assert stored(spark, target) == {("1", "z", "d1"): 1, ("3", "c", "d2"): 1}
    assert stored(spark, target, as_of="1") == {
        ("1", "a", "d1"): 1, ("2", "b", "d1"): 1, ("3", "c", "d2"): 1,
    }


def test_runs_are_named_in_order():
    names = [new_run() for _ in range(50)]
    assert names == sorted(names) and len(set(names)) == 50


def test_a_run_that_was_killed_leaves_the_table_as_it_was(spark, target):
    """Before it listed its partitions nothing of it is seen, however much it has written."""
    add_run(dim(spark, ("1", "a", "d1")), *target, run="1")
    later = dim(spark, ("1", "z", "d1"), ("2", "z", "d2"))
    write_partitioned(later, f"{target[0]}/data/run=2", PARTITIONS, "errorifexists")
    assert stored(spark, target) == {("1", "a", "d1"): 1}
    add_run(later, *target, run="3")
    assert stored(spark, target) == {("1", "z", "d1"): 1, ("2", "z", "d2"): 1}


def test_a_write_that_fails_leaves_the_table_as_it_was(spark, target):
    add_run(dim(spark, ("1", "a", "d1")), *target, run="1")
    broken = dim(spark, ("1", "z", "d1"), ("2", "z", "d2")).withColumn(
        "email_name", F.when(F.col("email_id") == "2", F.raise_error(F.lit("no"))).otherwise("z")
    )
    with pytest.raises(Exception, match="no"):
        add_run(broken, *target, run="2")
    assert stored(spark, target) == {("1", "a", "d1"): 1}


def test_a_run_is_added_once(spark, target):
    add_run(dim(spark, ("1", "a", "d1")), *target, run="1")
    with pytest.raises(Exception, match="(?i)exists"):
        add_run(dim(spark, ("1", "b", "d1")), *target, run="1")
    assert stored(spark, target) == {("1", "a", "d1"): 1}


def test_an_empty_run_replaces_nothing(spark, target):
    add_run(dim(spark, ("1", "a", "d1")), *target, run="1")
    add_run(dim(spark).where("false"), *target, run="2")
    assert stored(spark, target) == {("1", "a", "d1"): 1}


def test_partitions_can_be_emptied(spark, target):
    add_run(dim(spark, ("1", "a", "d1"), ("2", "b", "d2")), *target, run="1")
    gone = frame(spark, f"{DAY} string", ("d1",), ("d2",))
    add_run(dim(spark, ("2", "c", "d2")), *target, run="2", emptied=gone)
    assert stored(spark, target) == {("2", "c", "d2"): 1}


def test_a_null_partition_is_one_like_others(spark, target):
    add_run(dim(spark, ("1", "a", None), ("2", "b", "d2")), *target, run="1")
    add_run(dim(spark, ("1", "z", None)), *target, run="2")
    assert stored(spark, target) == {("1", "z", None): 1, ("2", "b", "d2"): 1}


def test_a_table_can_be_rewritten_from_itself(spark, target):
    add_run(dim(spark, ("1", "a", "d1"), ("2", "b", "d2")), *target, run="1")
    again = read_newest(spark, *target).where(F.col(DAY) == "d1").withColumn("email_name", F.lit("z"))
    add_run(again, *target, run="2")
    assert stored(spark, target) == {("1", "z", "d1"): 1, ("2", "b", "d2"): 1}


def test_superseded_runs_and_other_days_are_not_read(spark, target):
    days = [f"d{i}" for i in range(6)]
    for run in "123":
        add_run(dim(spark, *((day, run, day) for day in days)), *target, run=run)
    found, plan = ran(read_newest(spark, *target).where(F.col(DAY) < "d3"))
    assert {row.email_name for row in found} == {"3"} and len(found) == 3
    filters = re.findall(r"PartitionFilters: \[(.*?)PushedFilters", plan)
    assert any(re.search(r"run#\d+ = 3", f) and re.search(rf"{DAY}#\d+ <", f) for f in filters)
    newest = newest_partitions(spark, *target)
    assert rows(newest) == {(day, "3"): 1 for day in days}


def test_many_nearly_empty_partitions_are_written_by_many_tasks(spark, target):
    """A task writes one partition after the other, so they must not all go to one task."""
    days = spark.range(400).select(
        F.concat(F.lit("name "), "id").alias("email_id"),
        *(F.lit("x" * 200).cast(f.dataType).alias(f.name) if f.name == "email_name"
          else F.lit(None).cast(f.dataType).alias(f.name)
          for f in SCHEMA if f.name not in ("email_id", DAY)),
        F.concat(F.lit("d"), F.col("id") % 200).alias(DAY),
    )
    big = days.crossJoin(spark.range(60).select(F.uuid().alias("salt"))).withColumn(
        "email_id", F.concat("email_id", "salt")
    ).drop("salt")
    add_run(big, *target, run="1")
    files = read_newest(spark, *target).inputFiles()
    tasks = {name.rsplit("/part-")[1].split("-")[0] for name in files}
    assert len(files) < 200 * 3 and len(tasks) > 4
