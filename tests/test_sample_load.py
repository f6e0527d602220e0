"""The sample tables, loaded end to end, against results worked out by hand."""

import datetime as dt

import pytest

from tidemark import COURSES, FrameSource, ParquetSource, Warehouse, run
from tidemark.__main__ import main
from tidemark.plans.extract import extract, extract_counts
from tidemark.sources.sample import create_source, sample_tables

MART = [
    (i, f"Lesson {(i - 1) % 3 + 1}", teacher, module, stream, name, 5, course, title, False)
    for lessons, teacher, module, stream, name, course, title in [
        (range(1, 4), 1, 1, 1, "Stream Python 1", 1, "Python development"),
        (range(4, 7), 2, 2, 1, "Stream Python 1", 1, "Python development"),
        (range(7, 10), 2, 4, 3, "Stream Java 1 ", 2, "Java development"),
        (range(10, 13), 3, 5, 3, "Stream Java 1 ", 2, "Java development"),
    ]
    for i in lessons
]
COUNTS = {"course": 4, "stream": 4, "stream_module": 5, "lesson": 12}


@pytest.fixture(scope="module")
def source(spark, as_of):
    return FrameSource(sample_tables(spark, as_of))


@pytest.fixture
def warehouse(spark, new_root):
    model = COURSES.with_bucket_bits(dict.fromkeys(COURSES.targets, 2))
    return Warehouse.create(spark, new_root(), model)


def test_extract_counts(spark, source, as_of):
    frames = extract(COURSES, source, "2021-01-01", as_of)
    assert extract_counts(frames).first().asDict() == COUNTS


def test_tables_exist_empty_after_create(warehouse):
    for name in ["d_course", "d_stream", "d_stream_module", "f_lesson", "lesson_stream_dm"]:
        assert warehouse.table(name).count() == 0
        assert warehouse.table(name).schema == COURSES.schema_of(name)


def test_first_load(spark, warehouse, source, as_of, rows):
    result = run(COURSES, source, warehouse, "2021-01-01", as_of)
    assert result.affected == COUNTS
    assert result.frame().first().asDict() == {
        "affected_rows_course": 4,
        "affected_rows_stream": 4,
        "affected_rows_stream_module": 5,
        "affected_rows_lesson": 12,
    }
    assert rows(warehouse.table("lesson_stream_dm")) == sorted(MART, key=repr)
    assert warehouse.table("lesson_stream_dm").columns == [
        "id",
        "lesson_title",
        "teacher_id",
        "stream_module_id",
        "stream_id",
        "name",
        "homework_deadline_days",
        "course_id",
        "course_title",
        "is_demo_enroll",
    ]
    java = dt.datetime(2024, 3, 13, 10)
    day = dt.datetime(2024, 3, 14, 10)
    assert rows(warehouse.table("d_course").where("course_id = 2")) == [
        (2, "Java development", java, day, None, None, True, False)
    ]
    assert rows(warehouse.table("d_stream").where("stream_id = 4")) == [
        (
            4,
            dt.datetime(2024, 4, 15, 10),
            dt.datetime(2024, 9, 15, 10),
            day,
            day,
            None,
            True,
            "Stream Java 2",
            5,
        )
    ]
    assert rows(warehouse.table("f_lesson").where("id = 8")) == [
        (8, 4, 2, 3, "Lesson 2", "Lesson 2", as_of, as_of, None, 2, None, None, None)
    ]
    for name in ["d_course", "d_stream", "d_stream_module", "f_lesson", "lesson_stream_dm"]:
        assert warehouse.table(name).schema == COURSES.schema_of(name)


def test_stage_holds_all_extracted_columns(warehouse, source, as_of):
    run(COURSES, source, warehouse, "2021-01-01", as_of)
    staged = warehouse.staged("f_lesson")
    assert staged.columns[0] == "lesson_id"
    assert {"updated_at", "created_at", "stream_id", "course_id"} <= set(staged.columns)
    assert staged.count() == 12
    assert "course_id" in warehouse.staged("d_stream").columns


def test_second_identical_load_changes_nothing_but_counts_again(warehouse, source, as_of, rows):
    run(COURSES, source, warehouse, "2021-01-01", as_of)
    before = {n: rows(warehouse.table(n)) for n in [*COURSES.targets, "lesson_stream_dm"]}
    again = run(COURSES, source, warehouse, "2021-01-01", as_of)
    assert again.affected == COUNTS
    assert before == {n: rows(warehouse.table(n)) for n in before}


def test_default_window_is_yesterday(warehouse, source, as_of):
    assert run(COURSES, source, warehouse, as_of=as_of).affected == COUNTS


def test_empty_window_is_a_load_of_nothing(warehouse, source, as_of, rows):
    run(COURSES, source, warehouse, "2021-01-01", as_of)
    before = rows(warehouse.table("lesson_stream_dm"))
    later = run(COURSES, source, warehouse, as_of=as_of + dt.timedelta(days=1))
    assert set(later.affected.values()) == {0}
    assert rows(warehouse.table("lesson_stream_dm")) == before


def test_views_can_be_queried_with_sql(spark, warehouse, source, as_of):
    run(COURSES, source, warehouse, "2021-01-01", as_of)
    warehouse.register_views()
    found = spark.sql("select id from lesson_stream_dm where course_title like 'Java%'")
    assert sorted(r.id for r in found.collect()) == list(range(7, 13))


def test_parquet_source_gives_the_same_mart(spark, warehouse, as_of, rows, tmp_path):
    create_source(spark, str(tmp_path / "source"), as_of)
    source = ParquetSource(spark, str(tmp_path / "source"), COURSES.sources)
    assert run(COURSES, source, warehouse, "2021-01-01", as_of).affected == COUNTS
    assert rows(warehouse.table("lesson_stream_dm")) == sorted(MART, key=repr)


def test_command_line(spark, tmp_path, capsys, rows):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    main(["sample", "--source", source, "--as-of", "2024-03-15 10:00:00"])
    main(["create", "--warehouse", target])
    main(
        ["load", "--source", source, "--warehouse", target]
        + ["--date", "2021-01-01", "--as-of", "2024-03-15"]
    )
    assert capsys.readouterr().out.strip().endswith(
        "course: 4, stream: 4, stream_module: 5, lesson: 12"
    )
    assert rows(Warehouse(spark, target, COURSES).table("lesson_stream_dm")) == sorted(
        MART, key=repr
    )
