"""Column functions on hand-made rows."""

from datetime import datetime

import pytest
from helpers import at, frame, rows
from pyspark.sql import functions as F

from mailfacts.functions import (
    Bounds,
    bounce_code,
    email_key,
    from_year_month,
    locale_country,
    locale_language,
    mst_date,
    norm_key,
    null_sentinel,
    to_mst,
)


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_null_and_empty_become_the_sentinel(spark):
    df = frame(spark, "s string", ("",), (None,), ("a",), (" ",))
    assert values(df, null_sentinel("s")) == ["NULL", "NULL", "a", " "]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_mst_is_seven_hours_all_year(spark, kind):
    df = frame(spark, "t string", ("2024-07-01 03:00:00",), ("2024-01-01 03:00:00",))
    df = df.select(F.col("t").cast(kind).alias("t"))
    assert dict(df.select(to_mst("t").alias("m")).dtypes)["m"] == kind
    assert values(df, to_mst("t").cast("string")) == [
        "2024-06-30 20:00:00",
        "2023-12-31 20:00:00",
    ]
    assert values(df, mst_date(to_mst("t"))) == ["2024-06-30", "2023-12-31"]
    assert values(df, to_mst("t") + F.make_dt_interval(hours=F.lit(7)) == F.col("t")) == [True, True]


def test_shift_equals_the_named_zone(spark):
    df = spark.range(0, 366 * 24).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id"))).alias("t")
    )
    same = to_mst("t") == F.from_utc_timestamp("t", "-07:00")
    assert df.where(~same).count() == 0


def test_date_text_equals_the_formatter(spark):
    df = frame(spark, "t timestamp_ntz", (at("0987-03-04 23:59:59"),), (at("2024-02-29"),), (None,))
    got = values(df, mst_date("t"))
    assert got == values(df, F.date_format("t", "yyyy-MM-dd")) == ["0987-03-04", "2024-02-29", None]


def test_dates_do_not_depend_on_the_session_zone(spark, settings):
    df = frame(spark, "t timestamp_ntz", (datetime(2024, 3, 10, 9, 30),))
    settings(spark__sql__session__timeZone="America/New_York")
    # 02:30 does not exist in New York on that day.
    assert values(df, to_mst("t").cast("string")) == ["2024-03-10 02:30:00"]
    assert values(df, mst_date(to_mst("t"))) == ["2024-03-10"]


def test_key_skips_nulls_and_is_never_null(spark):
    df = frame(
        spark, "a string, b string, c string", ("a", None, "b"), ("a", "b", None), (None,) * 3
    )
    first, second, none = values(df, email_key("a", "b", "c"))
    assert first == second and none is not None and len(first) == 64 and first == first.lower()


def test_key_is_the_known_hash(spark):
    df = frame(spark, "a string, b int", ("x", 1))
    [key] = values(df, email_key("a", "b"))
    import hashlib

    assert key == hashlib.sha256(b"x|1").hexdigest()


def test_norm_key(spark):
    df = frame(spark, "s string", (" Ab ",), (None,), ("\tX",))
    assert values(df, norm_key("s")) == ["ab", None, "\tx"]
    assert values(frame(spark, "n int", (7,)), norm_key("n")) == ["7"]


def test_locale_parts(spark):
    df = frame(spark, "l string", ("en-US",), ("fr",), (None,), ("a-b-c",))
    got = list(zip(values(df, locale_language("l")), values(df, locale_country("l"))))
    assert got == [("en", "US"), ("fr", None), (None, None), ("a", "b")]


def test_bounce_code(spark):
    df = frame(
        spark,
        "b string",
        ("soft bounce",),
        ("unknown",),
        ("technical/other bounce",),
        ("a b c",),
        (None,),
    )
    assert values(df, bounce_code("b")) == ["sb", None, "tb", "ab", None]


def test_closed_bound_keeps_only_midnight_of_the_last_day(spark):
    df = frame(
        spark,
        "t timestamp_ntz",
        (at("2024-01-02 00:00:00"),),
        (at("2024-01-02 00:00:01"),),
        (at("2024-01-01"),),
        (None,),
    )
    closed = Bounds("2024-01-01", "2024-01-02")
    half_open = Bounds("2024-01-01", "2024-01-02", closed=False)
    assert df.where(closed.within(df, "t")).count() == 2
    assert df.where(half_open.within(df, "t")).count() == 1


def test_bounds_on_date_text(spark):
    df = frame(spark, "d string", ("2024-01-01",), ("2024-01-02",), ("2023-12-31",))
    bounds = Bounds("2024-01-01", "2024-01-02", closed=False)
    assert rows(df.where(bounds.within(df, "d"))) == {("2024-01-01",): 1}


def test_bounds_move_to_utc(spark):
    assert Bounds("2023-12-31", "2024-01-01 20:00:00").mst_to_utc() == Bounds(
        "2023-12-31 07:00:00", "2024-01-02 03:00:00"
    )


@pytest.mark.parametrize("kind", ["int", "string"])
def test_year_month_is_compared_as_a_pair(spark, kind):
    df = frame(
        spark, "year int, month int", (2023, 11), (2023, 12), (2024, 1), (2024, 11), (2022, 12)
    )
    df = df.select(*(F.col(c).cast(kind).alias(c) for c in df.columns))
    kept = df.where(from_year_month("2023-12-31"))
    assert rows(kept.select(*(F.col(c).cast("int") for c in df.columns))) == {
        (2023, 12): 1,
        (2024, 1): 1,
        (2024, 11): 1,
    }
