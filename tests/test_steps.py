"""Long jobs in steps: the same rows, with the shuffles of one step at a time on disk."""

import glob
import time

import pytest
from helpers import count, planned, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mailfacts import catalogue
from mailfacts.catalogue.fixtures import TABLES, Fixtures
from mailfacts.catalogue.queries import OCP_DATES, _ocp_sources
from mailfacts.plans.responses import ATTRIBUTED, ocp_responses
from mailfacts.session import scratch_dir
from mailfacts.sources.steps import Steps

# Forty orders of eight customers on twenty days, six lines each.
ROWS = {
    "region": (2, "id r_regionkey, concat('region ', id) r_name"),
    "nation": (3, "id n_nationkey, concat('nation ', id) n_name, id % 2 n_regionkey"),
    "customer": (8, "id c_custkey, concat('Customer ', id) c_name, id % 3 c_nationkey, 100 * id - 50 c_acctbal,"
                    " elt(id % 2 + 1, 'FURNITURE', 'MACHINERY') c_mktsegment"),
    "supplier": (5, "id s_suppkey, concat('Supplier ', id) s_name, id % 3 s_nationkey, 0 s_acctbal"),
    "part": (50, "id p_partkey, concat('part ', id) p_name, 'b' p_brand, 't' p_type, 1 p_size, 2 p_retailprice"),
    "orders": (40, "id o_orderkey, id % 8 o_custkey, elt(id % 3 + 1, 'O', 'F', 'P') o_orderstatus,"
                   " 20000 + 5000 * id o_totalprice, date_add(date'1996-05-01', cast(id % 20 as int)) o_orderdate,"
                   " elt(id % 4 + 1, '1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') o_orderpriority"),
    "lineitem": (240, "id div 6 l_orderkey, id % 7 l_partkey, id % 5 l_suppkey, id % 6 + 1 l_linenumber, 1 l_quantity,"
                      " 1 l_extendedprice, 0 l_discount, 0 l_tax, elt(id % 3 + 1, 'A', 'R', 'N') l_returnflag,"
                      " elt(id % 2 + 1, 'O', 'F') l_linestatus,"
                      " date_add(date'1996-05-03', cast(id div 6 % 20 as int)) l_shipdate"),
}
IN_STEPS = ["click_chain", "response_union", "response_fact_ocp", "response_fact_ocp_window", "flagged_response_fact_ocp"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, (n, columns) in ROWS.items():
        kinds = StructType.fromDDL(TABLES[name])
        table = spark.range(n).selectExpr(*columns.split(", ")) if "(" not in columns else spark.sql(f"SELECT {columns} FROM range({n})")
        table.select(*(F.col(f.name).cast(f.dataType) for f in kinds)).write.parquet(str(path / f"{name}.parquet"))
    return str(path)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_by(spark, build):
    """What ``build`` returns, and its shuffle files that are still there a little later."""
    before = shuffle_files(spark)
    built = build()
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return built, left


def test_a_step_gives_the_same_rows_and_frees_its_shuffles(spark):
    counted = spark.range(1000).groupBy(F.col("id") % 7).count()
    kept, left = left_by(spark, lambda: Steps("counts")("counted", counted))
    assert rows(kept) == rows(counted) and kept.schema.simpleString() == counted.schema.simpleString()
    assert not left


@pytest.mark.parametrize("name", IN_STEPS)
def test_responses_run_in_steps(spark, folder, name):
    """What is left of the plan reads the last steps only, and no shuffle of the others is left."""
    df, left = left_by(spark, lambda: catalogue.queries()[name](spark, folder))
    plan = planned(df)
    assert not left
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan
    assert count(r"Exchange hashpartitioning", plan) <= 12
    assert df.count() > 0


def test_steps_give_the_planned_responses(spark, folder):
    fx, keep = Fixtures(spark, folder), Steps("responses")
    planned_rows = rows(ocp_responses(*_ocp_sources(fx), OCP_DATES))
    in_steps = ocp_responses(*_ocp_sources(fx, keep), OCP_DATES, keep=keep)
    assert rows(keep.only(in_steps, *ATTRIBUTED)) == planned_rows
    assert {row[0] for row in rows(in_steps.select("email_response_type"))} == {"open", "click"}


@pytest.mark.parametrize("name", ["send_fact_ocp_sink", "response_fact_ocp_sink"])
def test_sinks_leave_their_table_only(spark, folder, name):
    df, left = left_by(spark, lambda: catalogue.queries()[name](spark, folder))
    assert not left
    top = scratch_dir(spark).removeprefix("file://")
    assert glob.glob(f"{top}/{name}-*/data") and not glob.glob(f"{top}/{name}-*-*")
    assert df.count() > 0
