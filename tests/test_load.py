"""Loads that fail, overlap, or meet odd rows; and the mart's upkeep."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import COURSES, ConstraintError, FrameSource, Warehouse, extract, load, run
from tidemark.operators import (
    affected_rows,
    changed_between_sql,
    conform,
    star_join,
    text_violations,
    transform,
    upsert,
)
from tidemark.plans.pipeline import refresh_mart
from tidemark.plans.sql_functions import create_functions
from tidemark.sources import declared_columns, inline_rows
from tidemark.sources.sample import sample_tables
from tidemark.specs import columns

TABLES = [*COURSES.targets, COURSES.mart.name]
DAY, HOUR = dt.timedelta(days=1), dt.timedelta(hours=1)
# Four keys in a partition.
SMALL = COURSES.with_bucket_bits(dict.fromkeys(COURSES.targets, 2))


@pytest.fixture(scope="module")
def sample(spark, as_of):
    return sample_tables(spark, as_of)


@pytest.fixture
def warehouse(spark, new_root):
    return Warehouse.create(spark, new_root(), SMALL)


def files(warehouse):
    """For every table the data files of each partition."""
    found = {}
    for name in TABLES:
        found[name] = {}
        for path in warehouse.spark.table(warehouse.name_of(name)).inputFiles():
            bucket = int(path.split("key_bucket=")[1].split("/")[0])
            found[name].setdefault(bucket, set()).add(path)
    return found


def rewritten(before, after):
    """For every table the partitions whose files have changed."""
    return {
        name: {b for b in before[name] | after[name] if before[name].get(b) != after[name].get(b)}
        for name in TABLES
    }


@pytest.fixture
def content(rows):
    return lambda warehouse: {name: rows(warehouse.table(name)) for name in TABLES}


def plus(spark, sample, table, **values):
    """The sample with one more row in a table; unnamed columns are NULL."""
    schema = COURSES.sources[table]
    row = inline_rows(spark, schema, [tuple(values.get(c) for c in schema.fieldNames())])
    return FrameSource(sample | {table: sample[table].unionByName(row)})


def changed(sample, table, where, **values):
    """The sample with values of some rows replaced."""
    df = sample[table]
    new = {c: F.when(F.expr(where), v).otherwise(F.col(c)) for c, v in values.items()}
    return sample | {table: df.withColumns(new)}


# -- failures ---------------------------------------------------------------


def breaking_sources(spark, sample, as_of):
    day = as_of - DAY
    return {
        "duplicate_keys": plus(spark, sample, "course", id=1, updated_at=day),
        "null_keys": plus(spark, sample, "stream", updated_at=day),
        "title_too_long": plus(spark, sample, "course", id=9, title="x" * 256, updated_at=day),
        "homework_url_too_long": plus(
            spark, sample, "stream_module_lesson", id=99, stream_module_id=1, homework_url="u" * 501
        ),
        "unknown keys": FrameSource(
            # The module was updated in the window, its stream never was.
            changed(sample, "stream", "id = 3", updated_at=F.lit(None))
        ),
    }


@pytest.mark.parametrize(
    "rule",
    ["duplicate_keys", "null_keys", "title_too_long", "homework_url_too_long", "unknown keys"],
)
def test_broken_rule_raises_and_changes_only_the_stage(
    spark, sample, warehouse, as_of, content, rule
):
    run(COURSES, FrameSource(sample), warehouse, "2024-02-01", "2024-03-01")
    before, stored = content(warehouse), files(warehouse)
    source = breaking_sources(spark, sample, as_of)[rule]
    with pytest.raises(ConstraintError, match=rule):
        run(COURSES, source, warehouse, "2021-01-01", as_of)
    assert content(warehouse) == before and files(warehouse) == stored
    # The stage shows what was tried, and the next good load replaces it.
    assert warehouse.staged("d_course").count() >= 4
    good = run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    assert good.affected["lesson"] == 12


def test_malformed_date_raises(sample, warehouse):
    with pytest.raises(ValueError):
        run(COURSES, FrameSource(sample), warehouse, date="first of May")


def test_a_new_session_finds_the_tables(spark, sample, warehouse, as_of, content):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    before = content(warehouse)
    for name in TABLES:
        spark.sql(f"drop table {warehouse.name_of(name)}")
    found = Warehouse(spark, warehouse.root, SMALL)
    assert content(found) == before
    again = run(COURSES, FrameSource(sample), found, "2021-01-01", as_of)
    assert again.affected["lesson"] == 12 and content(found) == before


def test_a_load_that_stopped_between_tables_is_run_again(
    spark, sample, warehouse, as_of, content, new_root, monkeypatch
):
    whole = Warehouse.create(spark, new_root(), SMALL)
    run(COURSES, FrameSource(sample), whole, "2021-01-01", as_of)
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of - DAY)
    own = Warehouse.replace

    def stopping(self, name, *args):
        if name in ("f_lesson", "lesson_stream_dm"):
            raise OSError("lost")
        own(self, name, *args)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "replace", stopping)
        with pytest.raises(OSError, match="lost"):
            run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    assert content(warehouse) == content(whole)


def test_a_write_of_longer_text_is_refused(spark, sample, warehouse, as_of):
    """Also one that is no load."""
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(
            f"insert into {warehouse.name_of('d_course')} "
            "select 9, repeat('x', 256), null, null, null, null, null, null, 2"
        )
    spark.sql(
        f"insert into {warehouse.name_of('d_course')} "
        "select 9, rpad('x', 300), null, null, null, null, null, null, 2"
    )
    assert len(warehouse.table("d_course").where("course_id = 9").first().title) == 255


def test_recreate_empties_every_table(sample, warehouse, as_of, content):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    again = Warehouse.create(warehouse.spark, warehouse.root, SMALL)
    assert content(again) == dict.fromkeys(TABLES, [])
    run(COURSES, FrameSource(sample), again, "2021-01-01", as_of)
    assert again.table("f_lesson").count() == 12


def test_a_failed_load_tells_what_it_extracted(spark, sample, warehouse, as_of, caplog):
    source = breaking_sources(spark, sample, as_of)["unknown keys"]
    with caplog.at_level("INFO", logger="tidemark.plans.pipeline"), pytest.raises(ConstraintError):
        run(COURSES, source, warehouse, "2021-01-01", as_of)
    assert all(not warehouse.buckets(name) for name in TABLES)
    # For every entity, also after the failing one.
    assert [m for m in caplog.messages if "extracted lesson rows: 12" in m]


# -- layouts ----------------------------------------------------------------


def keyed(spark, keys, title):
    """Frames with courses of these keys only."""
    frames = {
        e.name: inline_rows(spark, e.target.schema, []).toDF(*e.target.staged_columns)
        for e in COURSES.entities
    }
    course = COURSES.targets["d_course"]
    rows = [(key, title) + (None,) * (len(course.columns) - 2) for key in keys]
    return frames | {"course": inline_rows(spark, course.schema, rows)}


def test_sparse_keys_load(spark, new_root):
    """Keys from end to end of their type, then others and some again."""
    model = COURSES.with_bucket_bits({"d_course": 27})
    warehouse = Warehouse.create(spark, new_root(), model)
    low, high = -(2**31), 2**31 - 1
    first = [low, low + 1, -1, 0, 1, high] + list(range(-(2**31) + 77, 2**31, 2**24 + 3))
    load(COURSES, keyed(spark, first, "old"), warehouse)
    again = first[::3] + list(range(5, 2**31, 2**25))
    assert load(COURSES, keyed(spark, again, "new"), warehouse).affected["course"] == len(again)
    found = {r.course_id: r.title for r in warehouse.table("d_course").collect()}
    assert found == dict.fromkeys(first, "old") | dict.fromkeys(again, "new")
    assert warehouse.buckets("d_course") == set(range(-16, 16))


def test_untouched_partitions_keep_their_files(spark, warehouse):
    load(COURSES, keyed(spark, range(40), "old"), warehouse)
    before = files(warehouse)
    load(COURSES, keyed(spark, [5, 6, 13, 100], "new"), warehouse)
    after = files(warehouse)
    assert rewritten(before, after)["d_course"] == {1, 3, 25}
    assert len(before["d_course"]) == 10 and len(after["d_course"]) == 11


# -- odd rows ---------------------------------------------------------------


def test_null_watermark_is_never_extracted(spark, sample, warehouse, as_of):
    source = plus(spark, sample, "course", id=9, title="no date")
    assert run(COURSES, source, warehouse, "2021-01-01", as_of).affected["course"] == 4


def test_all_null_columns_load(spark, sample, warehouse, as_of, rows):
    lessons = sample["stream_module_lesson"]
    source = FrameSource(
        changed(sample, "stream", "true", start_at=F.lit(None), name=F.lit(None))
        | {"stream_module_lesson": lessons.withColumn("teacher_id", F.lit(None))}
    )
    run(COURSES, source, warehouse, "2021-01-01", as_of)
    found = warehouse.table("lesson_stream_dm")
    assert found.schema == COURSES.mart_schema
    assert {(r.name, r.teacher_id) for r in found.collect()} == {(None, None)}


def test_null_reference_loads_but_is_not_in_the_mart(spark, sample, warehouse, as_of):
    frames = {
        e.name: inline_rows(spark, e.target.schema, []).toDF(*e.target.staged_columns)
        for e in COURSES.entities
    }
    lesson = COURSES.targets["f_lesson"]
    frames["lesson"] = inline_rows(
        spark, lesson.schema, [(1,) + (None,) * (len(lesson.columns) - 1)]
    ).toDF(*lesson.staged_columns)
    assert load(COURSES, frames, warehouse).affected["lesson"] == 1
    assert warehouse.table("f_lesson").count() == 1
    assert warehouse.table("lesson_stream_dm").count() == 0


def test_precision_length_and_sign_of_keys(spark, sample, warehouse, as_of, rows):
    source = plus(
        spark,
        sample,
        "course",
        id=-7,
        title="x" * 255 + "   ",
        updated_at=as_of - DAY,
        deleted_at=dt.datetime(2024, 3, 14, 1, 1, 1, 500000),
    )
    run(COURSES, source, warehouse, "2021-01-01", as_of)
    found = warehouse.table("d_course").where("course_id = -7").first()
    assert found.title == "x" * 255
    assert found.deleted_at == dt.datetime(2024, 3, 14, 1, 1, 2)


def test_soft_deleted_rows_stay_in_the_mart(sample, warehouse, as_of):
    gone = changed(sample, "stream_module_lesson", "id = 1", deleted_at=F.lit(as_of))
    run(COURSES, FrameSource(gone), warehouse, "2021-01-01", as_of)
    assert warehouse.table("lesson_stream_dm").count() == 12
    assert warehouse.table("f_lesson").where("deleted_at is not null").count() == 1


def test_rows_removed_at_the_source_stay(sample, warehouse, as_of, content):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    before = content(warehouse)
    rest = FrameSource(sample | {"course": sample["course"].where("id < 3")})
    assert run(COURSES, rest, warehouse, "2021-01-01", as_of).affected["course"] == 2
    assert content(warehouse) == before


def test_batch_wins_whatever_its_age(spark, sample, warehouse, as_of):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    older = changed(
        sample, "course", "id = 1", title=F.lit("Older"), updated_at=F.lit(as_of - 30 * DAY)
    )
    counts = run(COURSES, FrameSource(older), warehouse, "2024-02-01", "2024-03-01")
    assert counts.affected == {"course": 1, "stream": 0, "stream_module": 0, "lesson": 0}
    assert warehouse.table("d_course").where("course_id = 1").first().title == "Older"


# -- the mart ---------------------------------------------------------------


def test_changed_dimension_reaches_facts_of_earlier_loads(sample, warehouse, as_of):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    later = as_of + DAY
    moved = changed(
        sample, "course", "id = 1", title=F.lit("Python"), updated_at=F.lit(as_of + HOUR)
    )
    counts = run(COURSES, FrameSource(moved), warehouse, as_of=later)
    assert counts.affected == {"course": 1, "stream": 0, "stream_module": 0, "lesson": 0}
    found = {(r.course_id, r.course_title) for r in warehouse.table("lesson_stream_dm").collect()}
    assert found == {(1, "Python"), (2, "Java development")}


def test_only_stale_partitions_are_rewritten(spark, sample, warehouse, as_of):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    moved = changed(
        sample, "course", "id = 2", title=F.lit("JVM"), updated_at=F.lit(as_of + HOUR)
    )
    before = files(warehouse)
    run(COURSES, FrameSource(moved), warehouse, as_of=as_of + DAY)
    # Course 2 is shown by lessons 7 to 12; keys 4-7 are partition 1.
    assert rewritten(before, files(warehouse)) == {
        "d_course": {0},
        "d_stream": set(),
        "d_stream_module": set(),
        "f_lesson": set(),
        "lesson_stream_dm": {1, 2, 3},
    }


def test_a_change_the_mart_does_not_show_leaves_it_alone(sample, warehouse, as_of):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    moved = changed(
        sample, "course", "id = 2", icon_url=F.lit("i"), updated_at=F.lit(as_of + HOUR)
    )
    before = files(warehouse)
    run(COURSES, FrameSource(moved), warehouse, as_of=as_of + DAY)
    changed_files = rewritten(before, files(warehouse))
    assert changed_files["d_course"] and not changed_files["lesson_stream_dm"]


def test_facts_that_lose_their_references_leave_the_mart(sample, warehouse, as_of):
    """A partition without rows is no partition of an overwrite, and must go too."""
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    lessons = warehouse.table("f_lesson").where("id between 8 and 12")
    gone = lessons.withColumn("course_id", F.lit(None).cast("int"))
    lesson = COURSES.targets["f_lesson"]
    frames = keyed(warehouse.spark, [], "") | {"lesson": gone.toDF(*lesson.staged_columns)}
    load(COURSES, frames, warehouse)
    shown = {r.id for r in warehouse.table("lesson_stream_dm").collect()}
    assert shown == {1, 2, 3, 4, 5, 6, 7}
    assert warehouse.buckets("lesson_stream_dm") == {0, 1}


@pytest.mark.parametrize("limit", ["64m", "-1"])
def test_refreshed_mart_equals_a_recomputed_one(spark, sample, warehouse, as_of, rows, limit):
    """Random days of changes, with the dimensions broadcast and without."""
    keys = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    ]
    settings = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, limit)
    try:
        rng, tables = random.Random(7), dict(sample)
        for day in range(3):
            now = as_of + day * DAY
            run(COURSES, FrameSource(tables), warehouse, "2021-01-01" if day == 0 else None, now)
            recomputed = star_join(COURSES.mart, {n: warehouse.table(n) for n in COURSES.targets})
            assert rows(warehouse.table("lesson_stream_dm")) == rows(recomputed)
            touched = F.lit(now + HOUR)
            for table, column in {"course": "title", "stream": "name"}.items():
                tables = changed(
                    tables,
                    table,
                    f"id = {rng.randint(1, 5)}",
                    **{column: F.lit(f"{table} on day {day}"), "updated_at": touched},
                )
        before = rows(warehouse.table("lesson_stream_dm"))
        refresh_mart(warehouse)
        assert rows(warehouse.table("lesson_stream_dm")) == before
    finally:
        for key, value in settings.items():
            spark.conf.set(key, value)


# -- in SQL -----------------------------------------------------------------


def test_sql_functions_tell_what_an_upsert_does(spark, sample, warehouse, as_of, rows):
    run(COURSES, FrameSource(sample), warehouse, "2021-01-01", as_of)
    moved = changed(sample, "course", "id in (1, 2)", title=F.lit("Moved"))
    more = plus(spark, moved, "stream", id=9, course_id=1, name="New", updated_at=as_of - DAY)
    frames = transform(extract(COURSES, more, "2021-01-01", as_of), COURSES.entities)
    before = {name: warehouse.table(name) for name in COURSES.targets}
    batches = {}
    for entity in COURSES.entities:
        staged, _ = warehouse.stage(entity.target.name, frames[entity.name])
        batches[entity.target.name] = conform(staged, entity.target)
    names = create_functions(warehouse)
    assert len(names) == 2 * len(COURSES.targets) + 1
    for name, target in COURSES.targets.items():
        expected = upsert(before[name], batches[name], [target.key])
        assert rows(spark.sql(f"select * from upserted_{name}()")) == rows(expected)
        count = spark.sql(f"select * from upsert_{name}()").first()[0]
        assert count == affected_rows(batches[name]).first()[0]
    assert spark.sql("select * from upsert_all()").first().asDict() == {
        "affected_rows_course": 4,
        "affected_rows_stream": 5,
        "affected_rows_stream_module": 5,
        "affected_rows_lesson": 12,
    }


def test_a_table_name_is_only_a_name(spark, sample, as_of):
    sample["course"].createOrReplaceTempView("course_of_sql")
    found = changed_between_sql(spark, "course_of_sql", "updated_at", "2021-01-01", as_of)
    assert found.count() == 4
    for name in ("course_of_sql where 1 = 1 --", "course_of_sql'; drop table x", "`a'b`.`c`"):
        with pytest.raises(AnalysisException):
            changed_between_sql(spark, name, "updated_at", "2021-01-01", as_of)


def test_a_declared_table_refuses_each_violating_row(spark, new_root):
    texts = ["abc", "abcd", "ab   ", "äöüß", None]
    df = inline_rows(spark, columns("k int, t string"), list(enumerate(texts, 1)))
    declared = declared_columns(df.schema, {"t": 3})
    spark.sql(f"create table short_text ({declared}) using parquet location '{new_root()}'")
    try:
        refused = set()
        for row in df.collect():
            try:
                df.where(F.col("k") == row.k).write.insertInto("short_text")
            except Exception as error:
                assert "EXCEED_LIMIT_LENGTH" in str(error)
                refused.add(row.k)
        assert refused == {r.k for r in text_violations(df, {"t": 3}).collect()} == {2, 4}
        assert {(r.k, r.t) for r in spark.table("short_text").collect()} == {
            (1, "abc"),
            (3, "ab "),
            (5, None),
        }
    finally:
        spark.sql("drop table short_text")
