import zlib
from collections import Counter

import corpus_pipeline
import pytest
from __spark_entry__ import oracle_sql, queries
from test_minmax_dedup import brute_force

from tidemark.llm import decontaminate, pu_quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, stored and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        after = spark.read.parquet(str(folder / name))
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_return_documents(steps):
    *others, last = steps.values()
    for before, after in others:
        assert after.schema == before.schema
    assert "shard" in last[1].columns


def test_quality_decides(spark, steps):
    before, after = steps["quality_classifier"]
    model = pu_quality.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    predicted = {r.doc_id for r in pu_quality.score(before, model).collect() if r.predicted}
    assert set(ids(after)) == predicted and 0 < after.count() < before.count()


def test_one_of_each_group_stays(steps):
    before, after = steps["near_dedup"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    found = brute_force(rows, corpus_pipeline.SIMILAR_PERCENT)
    assert ids(after) == Counter(doc_id for doc_id, (_, _, kept) in found.items() if kept)
    assert 0 < after.count() < before.count()


def test_contaminated_documents_go(spark, steps):
    before, after = steps["benchmark_decontamination"]
    found = decontaminate.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
    clean = [r.doc_id for r in found.collect() if not r.contaminated]
    assert ids(after) == Counter(clean) and 0 < len(clean) < before.count()


def test_mixing_keeps_every_document(steps):
    before, after = steps["source_mixing"]
    assert set(ids(after)) == set(ids(before)) and max(ids(after).values()) <= 2


def test_shards_hold_every_row(steps):
    before, after = steps["sharding"]
    texts = Counter((r.doc_id, zlib.crc32((r.text or "").encode())) for r in before.collect())
    assert Counter((r.doc_id, r.text_crc32) for r in after.collect()) == texts
    counts = Counter(r.shard for r in after.collect())
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(40)) <= 1


def test_run_gives_the_rows_of_the_last_stage(spark, steps):
    rows = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert rows == Counter(tuple(r) for r in steps["sharding"][1].collect())


def test_empty_and_odd_documents(frame, prose):
    for rows in ([], [(1, None), (None, ""), (2, prose(80)), (2, prose(80)), (3, "x")]):
        docs = frame(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(docs.sparkSession, docs, SF)
            docs.collect()


def test_registered():
    names = set(queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)}
    assert {"op6_rule_ledger", "op8_source_mix", "op9_decontaminate"} <= set(oracle_sql())
