"""The sample source tables: 4 courses, 4 streams, 5 modules, 12 lessons.

Dates are offsets from one instant, ``as_of``, so a load can be repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import shift
from tidemark.functions.timestamps import DateLike, as_datetime
from tidemark.plans.courses import SOURCE_TABLES
from tidemark.sources.inline import inline_rows
from tidemark.specs import columns

# The sample rows.  "d" counts days and "m" months from as_of.
# id, title, created d, updated d, auto enroll, demo enroll
_COURSES = [
    (1, "Python development", -1, -1, True, False),
    (2, "Java development", -2, -1, True, False),
    (3, "C# development", -1, -1, False, False),
    (4, "Marketing", -1, -1, True, True),
]
# id, course, start m, end m, name
_STREAMS = [
    (1, 1, 0, 5, "Stream Python 1"),
    (2, 1, 1, 6, "Stream Python 2"),
    (3, 2, 0, 5, "Stream Java 1 "),
    (4, 2, 1, 6, "Stream Java 2"),
]
# id, stream, title, order in stream
_MODULES = [
    (1, 1, "Django backend", 1),
    (2, 1, "DRF", 2),
    (3, 1, "Algs", 3),
    (4, 3, "Java essentials", 1),
    (5, 3, "Java advanced", 2),
]
# id, title (also the description), teacher, module
_LESSONS = [
    (1, "Lesson 1", 1, 1),
    (2, "Lesson 2", 1, 1),
    (3, "Lesson 3", 1, 1),
    (4, "Lesson 1", 2, 2),
    (5, "Lesson 2", 2, 2),
    (6, "Lesson 3", 2, 2),
    (7, "Lesson 1", 2, 4),
    (8, "Lesson 2", 2, 4),
    (9, "Lesson 3", 2, 4),
    (10, "Lesson 1", 3, 5),
    (11, "Lesson 2", 3, 5),
    (12, "Lesson 3", 3, 5),
]
_HOMEWORK_DEADLINE_DAYS = 5


def _complete(df: DataFrame, schema: T.StructType, **computed: Column) -> DataFrame:
    """``df`` with the computed columns, and NULL for what is left."""
    chosen = []
    for field in schema:
        if field.name in computed:
            column = computed[field.name]
        elif field.name in df.columns:
            column = F.col(field.name)
        else:
            column = F.lit(None)
        chosen.append(column.cast(field.dataType).alias(field.name))
    return df.select(*chosen)


def sample_tables(spark: SparkSession, as_of: DateLike) -> dict[str, DataFrame]:
    """The four sample tables as they stand at ``as_of``."""
    now = F.lit(as_datetime(as_of))
    yesterday = shift(now, days=-1)

    def rows(names: str, data: list[tuple]) -> DataFrame:
        return inline_rows(spark, columns(names), data)

    courses = rows(
        "id int, title string, created int, updated int,"
        " is_auto_course_enroll boolean, is_demo_enroll boolean",
        _COURSES,
    )
    streams = rows("id int, course_id int, start int, end int, name string", _STREAMS)
    modules = rows("id int, stream_id int, title string, order_in_stream int", _MODULES)
    lessons = rows("id int, title string, teacher_id int, stream_module_id int", _LESSONS)
    return {
        "course": _complete(
            courses,
            SOURCE_TABLES["course"],
            created_at=shift(now, days=F.col("created")),
            updated_at=shift(now, days=F.col("updated")),
        ),
        "stream": _complete(
            streams,
            SOURCE_TABLES["stream"],
            start_at=shift(now, months=F.col("start")),
            end_at=shift(now, months=F.col("end")),
            created_at=yesterday,
            updated_at=yesterday,
            is_open=F.lit(True),
            homework_deadline_days=F.lit(_HOMEWORK_DEADLINE_DAYS),
        ),
        "stream_module": _complete(
            modules, SOURCE_TABLES["stream_module"], created_at=yesterday, updated_at=yesterday
        ),
        "stream_module_lesson": _complete(
            lessons,
            SOURCE_TABLES["stream_module_lesson"],
            description=F.col("title"),
            start_at=now,
            end_at=now,
        ),
    }


def create_source(spark: SparkSession, root: str, as_of: DateLike | None = None) -> None:
    """(Re)create the source tables as parquet below ``root``, with the
    sample rows."""
    for name, df in sample_tables(spark, as_of or dt.datetime.now()).items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
