"""The model this library ships: courses, their streams (cohorts), modules
and lessons, loaded into a star schema with one mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import to_date
from tidemark.specs import (
    DetailView,
    Entity,
    Model,
    Reference,
    StarMart,
    TableReader,
    TargetSpec,
    columns,
)


# Table, column and view names, types, lengths, keys and
# references of the source and of the warehouse.
SOURCE_TABLES = {
    "course": columns("""
        id int
        title string
        created_at timestamp_ntz
        updated_at timestamp_ntz
        deleted_at timestamp_ntz
        icon_url string
        is_auto_course_enroll boolean
        is_demo_enroll boolean
    """),
    "stream": columns("""
        id int
        course_id int
        start_at timestamp_ntz
        end_at timestamp_ntz
        created_at timestamp_ntz
        updated_at timestamp_ntz
        deleted_at timestamp_ntz
        is_open boolean
        name string
        homework_deadline_days int
    """),
    "stream_module": columns("""
        id int
        stream_id int
        title string
        created_at timestamp_ntz
        updated_at timestamp_ntz
        order_in_stream int
        deleted_at timestamp_ntz
    """),
    "stream_module_lesson": columns("""
        id int
        title string
        description string
        start_at timestamp_ntz
        end_at timestamp_ntz
        homework_url string
        teacher_id int
        stream_module_id int
        deleted_at timestamp_ntz
        online_lesson_join_url string
        online_lesson_recording_url string
    """),
}

LESSON_VIEW = "etl_f_stream_module_lesson_view"

D_COURSE = TargetSpec(
    name="d_course",
    key="course_id",
    schema=columns("""
        course_id int
        title string
        created_at timestamp_ntz
        updated_at timestamp_ntz
        deleted_at timestamp_ntz
        icon_url string
        is_auto_course_enroll boolean
        is_demo_enroll boolean
    """),
    text_limits={"title": 255, "icon_url": 255},
    whole_seconds=frozenset({"deleted_at"}),
)

D_STREAM = TargetSpec(
    name="d_stream",
    key="stream_id",
    schema=columns("""
        stream_id int
        start_at timestamp_ntz
        end_at timestamp_ntz
        created_at timestamp_ntz
        updated_at timestamp_ntz
        deleted_at timestamp_ntz
        is_open boolean
        name string
        homework_deadline_days int
    """),
    text_limits={"name": 255},
)

D_STREAM_MODULE = TargetSpec(
    name="d_stream_module",
    key="stream_module_id",
    schema=columns("""
        stream_module_id int
        title string
        created_at timestamp_ntz
        updated_at timestamp_ntz
        order_in_stream int
        deleted_at timestamp_ntz
    """),
    text_limits={"title": 255},
)

F_LESSON = TargetSpec(
    name="f_lesson",
    key="id",
    schema=columns("""
        id int
        stream_module_id int
        course_id int
        stream_id int
        title string
        description string
        start_at timestamp_ntz
        end_at timestamp_ntz
        homework_url string
        teacher_id int
        deleted_at timestamp_ntz
        online_lesson_join_url string
        online_lesson_recording_url string
    """),
    staged_as=(
        "lesson_id",
        "stream_module_id",
        "course_id",
        "stream_id",
        "title",
        "description",
        "start_at",
        "end_at",
        "homework_url",
        "teacher_id",
        "deleted_at",
        "online_lesson_join_url",
        "online_lesson_recording_url",
    ),
    references=(
        Reference("stream_module_id", "d_stream_module"),
        Reference("course_id", "d_course"),
        Reference("stream_id", "d_stream"),
    ),
    text_limits={
        "title": 255,
        "homework_url": 500,
        "online_lesson_join_url": 255,
        "online_lesson_recording_url": 255,
    },
)

LESSON_MART = StarMart(
    name="lesson_stream_dm",
    fact="f_lesson",
    key="id",
    joins=(("d_stream", "stream_id"), ("d_course", "course_id")),
    columns=(
        ("f_lesson", "id", "id"),
        ("f_lesson", "title", "lesson_title"),
        ("f_lesson", "teacher_id", "teacher_id"),
        ("f_lesson", "stream_module_id", "stream_module_id"),
        ("f_lesson", "stream_id", "stream_id"),
        ("d_stream", "name", "name"),
        ("d_stream", "homework_deadline_days", "homework_deadline_days"),
        ("f_lesson", "course_id", "course_id"),
        ("d_course", "title", "course_title"),
        ("d_course", "is_demo_enroll", "is_demo_enroll"),
    ),
)


def lesson_ancestors(table: TableReader) -> DataFrame:
    """Per module what its lessons inherit: stream and course, and the
    module's dates, one of which is the lessons' watermark."""
    module, stream = table("stream_module").alias("module"), table("stream").alias("stream")
    return module.join(stream, F.col("module.stream_id") == F.col("stream.id")).select(
        F.col("module.id").alias("stream_module_id"),
        "module.stream_id",
        "stream.course_id",
        to_date(F.col("module.updated_at")).alias("updated_at"),
        to_date(F.col("module.created_at")).alias("created_at"),
    )


COURSES = Model(
    sources=SOURCE_TABLES,
    views={LESSON_VIEW: DetailView("stream_module_lesson", "stream_module_id", lesson_ancestors)},
    entities=(
        Entity("course", "course", D_COURSE),
        Entity("stream", "stream", D_STREAM),
        Entity("stream_module", "stream_module", D_STREAM_MODULE),
        Entity("lesson", LESSON_VIEW, F_LESSON),
    ),
    mart=LESSON_MART,
)
