"""Scalar expressions at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    as_date,
    as_datetime,
    default_start,
    drop_blank_excess,
    exceeds,
    round_to_second,
    shift,
    text_to_date,
    text_to_timestamp,
    to_date,
)
from tidemark.plans.extract import window
from tidemark.sources import inline_rows
from tidemark.specs import columns


def times(*texts):
    return [(dt.datetime.fromisoformat(t),) for t in texts]


def test_job_arguments():
    assert as_date("2021-01-01") == dt.date(2021, 1, 1)
    assert as_date("2024-03-14 10:00:00.123456") == dt.date(2024, 3, 14)
    assert as_datetime(dt.date(2024, 3, 14)) == dt.datetime(2024, 3, 14)
    assert default_start(dt.datetime(2024, 3, 1, 9)) == dt.date(2024, 2, 29)
    with pytest.raises(ValueError):
        as_date("yesterday")


def test_window_defaults_are_evaluated_per_call(spark):
    start, end = window(None, None)
    assert end - start == dt.timedelta(days=1)
    assert window("2021-01-01", "2024-03-15 10:00:00") == (
        dt.date(2021, 1, 1),
        dt.date(2024, 3, 15),
    )


def test_round_to_second(spark):
    df = inline_rows(
        spark,
        columns("t timestamp_ntz"),
        times(
            "2024-01-01 00:00:00.499999",
            "2024-01-01 00:00:00.500000",
            "2023-12-31 23:59:59.500000",
            "1999-12-31 23:59:58.500000",
            "1999-12-31 23:59:58.500001",
            "1999-12-31 23:59:59.500000",
        )
        + [(None,)],
    )
    found = df.select(round_to_second(F.col("t")).alias("r"))
    assert found.schema["r"].dataType.simpleString() == "timestamp_ntz"
    assert [r.r and str(r.r) for r in found.collect()] == [
        "2024-01-01 00:00:00",
        "2024-01-01 00:00:01",
        "2024-01-01 00:00:00",
        "1999-12-31 23:59:58",
        "1999-12-31 23:59:59",
        "1999-12-31 23:59:59",
        None,
    ]


def test_local_times_that_a_session_zone_lacks(spark):
    """02:30 on this day does not exist in New York; here it is any time."""
    df = inline_rows(spark, columns("t timestamp_ntz"), times("2024-03-10 02:30:00.600000"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = df.select(
            round_to_second(F.col("t")),
            shift(F.col("t"), days=1),
            shift(F.col("t"), months=-1),
            text_to_timestamp(F.lit("2024-03-10 02:30:00")),
            to_date(F.col("t")),
        )
        assert {f.dataType.simpleString() for f in found.schema} == {"timestamp_ntz", "date"}
        assert [str(v) for v in found.first()] == [
            "2024-03-10 02:30:01",
            "2024-03-11 02:30:00.600000",
            "2024-02-10 02:30:00.600000",
            "2024-03-10 02:30:00",
            "2024-03-10",
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_shift_clamps_to_month_end(spark):
    df = inline_rows(spark, columns("t timestamp_ntz"), times("2024-01-31 10:00:00"))
    found = df.select(
        shift(F.col("t"), months=1), shift(F.col("t"), days=-1), shift(F.col("t"), months=1, days=1)
    )
    assert [str(v) for v in found.first()] == [
        "2024-02-29 10:00:00",
        "2024-01-30 10:00:00",
        "2024-03-01 10:00:00",
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_parsing_is_strict_in_any_session(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = inline_rows(
            spark, columns("t string"), [("2024-03-14 10:00:00.5",), ("2024-03-14",), (None,)]
        )
        assert [r[0] for r in good.select(text_to_date(F.col("t"))).collect()] == [
            dt.date(2024, 3, 14),
            dt.date(2024, 3, 14),
            None,
        ]
        assert [r[0] for r in good.select(text_to_timestamp(F.col("t"))).collect()] == [
            dt.datetime(2024, 3, 14, 10, 0, 0, 500000),
            dt.datetime(2024, 3, 14),
            None,
        ]
        bad = inline_rows(spark, columns("t string"), [("2024-13-99",)])
        for parse in (text_to_date, text_to_timestamp):
            with pytest.raises(Exception, match="not a (date|timestamp_ntz): 2024-13-99"):
                bad.select(parse(F.col("t"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_limited_text(spark):
    df = inline_rows(
        spark,
        columns("t string"),
        [("abc",), ("abcde   ",), ("abc    ",), ("abcdef",), ("ab cd f",), ("",), (None,)],
    )
    found = df.select(
        exceeds(F.col("t"), 5).alias("over"), drop_blank_excess(F.col("t"), 5).alias("kept")
    ).collect()
    assert [r.over for r in found] == [False, False, False, True, True, False, False]
    assert [r.kept for r in found] == ["abc", "abcde", "abc  ", "abcdef", "ab cd f", "", None]
