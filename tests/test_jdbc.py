"""JDBC settings.  No database is opened here: what is sent to Spark is checked."""

import argparse

from tidemark import COURSES, JdbcSource
from tidemark.__main__ import source_of
from tidemark.plans.courses import LESSON_VIEW
from tidemark.sources import Slices
from tidemark.sources.jdbc import replace_options

URL = "jdbc:postgresql://host/db"


def test_read_options(spark):
    source = JdbcSource(
        spark,
        URL,
        COURSES.sources,
        properties={"driver": "org.postgresql.Driver", "user": "u"},
        slices={"stream_module_lesson": Slices("id", 0, 1_000_000, 64)},
    )
    assert source.options("course") == {
        "driver": "org.postgresql.Driver",
        "user": "u",
        "url": URL,
        "dbtable": "course",
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
    }
    cut = source.options("stream_module_lesson")
    assert cut["partitionColumn"] == "id"
    assert (cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == ("0", "1000000", "64")


def test_views_come_from_spark_unless_named(spark):
    assert not JdbcSource(spark, URL, COURSES.sources).provides(LESSON_VIEW)
    assert JdbcSource(spark, URL, COURSES.sources, views=frozenset({LESSON_VIEW})).provides(
        LESSON_VIEW
    )


def test_replace_keeps_the_table_definition():
    options = replace_options(URL, "d_course_stage", {"user": "u"}, connections=4)
    assert options == {
        "user": "u",
        "url": URL,
        "dbtable": "d_course_stage",
        "truncate": "true",
        "numPartitions": "4",
    }


def test_command_line_reads_a_database(spark):
    args = argparse.Namespace(
        source=None,
        jdbc_url=URL,
        jdbc_property=["driver=org.postgresql.Driver", "password=a=b"],
        jdbc_slices=["stream_module_lesson:id:0:1000:8"],
        jdbc_view=[LESSON_VIEW],
    )
    source = source_of(spark, args)
    options = source.options("stream_module_lesson")
    assert (options["url"], options["password"], options["numPartitions"]) == (URL, "a=b", "8")
    assert source.provides(LESSON_VIEW) and source.provides("course")
