"""Every query against its SQL on the smallest test tables."""

from datetime import date, timedelta

import check
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mailfacts import catalogue
from mailfacts.catalogue.parameters import WINDOW
from mailfacts.functions import Bounds
from mailfacts.plans.responses import ResponseDates

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
    assert set(catalogue.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_equals_sql(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    assert check.differences(df, connection, entry.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_both_flag_forms_agree(spark):
    queries = entry.queries()
    one, other = (
        queries[name](spark, FOLDER)
        for name in ("first_response_flags_incremental", "first_response_flags_join")
    )
    assert one.exceptAll(other).count() == 0 == other.exceptAll(one).count()


def test_incremental_flags_are_the_full_ones(spark):
    """Flags of a late range do not depend on how much else is rewritten."""
    queries = entry.queries()
    part = queries["first_response_flags_incremental"](spark, FOLDER)
    full = queries["first_response_flags"](spark, FOLDER)
    assert part.exceptAll(full).count() == 0


def test_the_stored_fact_is_flagged_on_all_days(spark, connection):
    df = entry.queries()["response_fact_ocp_sink"](spark, FOLDER)
    assert check.differences(df, connection, entry.oracle_sql()["flagged_response_fact_ocp"]) == []


def test_one_pass_and_two_branch_split_agree(spark):
    queries = entry.queries()
    one, other = (queries[name](spark, FOLDER) for name in ("channel_split", "channel_split_union"))
    assert one.exceptAll(other.select(*one.columns)).count() == 0
    assert one.count() == other.count()


# --- Every bound of a run counts --------------------------------------------------------------

WINDOW_FOLDER = "/root/testdata/sf0.01"


def window_rows(spark, dates):
    from mailfacts.catalogue.fixtures import Fixtures
    from mailfacts.catalogue.queries import _ocp_sources
    from mailfacts.plans.responses import ocp_responses

    df = ocp_responses(*_ocp_sources(Fixtures(spark, WINDOW_FOLDER)), dates)
    whole = F.sum(F.xxhash64(*df.columns).cast("decimal(30)"))
    return tuple(df.agg(F.count("*"), whole).first())


@pytest.fixture(scope="module")
def window_result(spark):
    return window_rows(spark, ResponseDates(**WINDOW))


@pytest.mark.parametrize("name", list(WINDOW))
def test_each_date_of_a_response_run_counts(spark, window_result, name):
    """A day's move of any one of the six dates changes the responses."""
    moved = (date.fromisoformat(WINDOW[name]) + timedelta(days=1)).isoformat()
    assert window_rows(spark, ResponseDates(**WINDOW | {name: moved})) != window_result


@pytest.mark.parametrize("number", range(6))
def test_each_closed_or_open_end_counts(spark, window_result, monkeypatch, number):
    """Turning any one of the ranges of a response run from closed to half-open or back changes
    the responses. Numbered as they are built: history, stage, opens, queue, clicks, click queue."""
    from mailfacts.plans import responses

    built = []

    def turned(lo, hi, closed=True):
        built.append(lo)
        return Bounds(lo, hi, closed != (len(built) - 1 == number))

    monkeypatch.setattr(responses, "Bounds", turned)
    assert window_rows(spark, ResponseDates(**WINDOW)) != window_result
    assert len(built) == 6
