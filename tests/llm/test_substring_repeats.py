import hashlib
import random

from tidemark.llm import substring_repeats as op


def brute_force(rows, window=50):
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            key = tuple(words[i : i + window])
            first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        cut = set()
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            if first[tuple(words[i : i + window])] < doc_id:
                cut.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in cut)
        out.append((doc_id, len(words), len(cut), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in op.digest(op.cut_repeats(df)).collect()), key=repr)


def test_partial_overlaps_equal_brute_force(frame, prose):
    draw, passages, rows = random.Random(3), [prose(90) for _ in range(5)], []
    for doc_id in range(60):
        parts = []
        for _ in range(draw.randint(1, 4)):
            words = draw.choice(passages).split()
            # Cut on either side, so that only some windows are shared.
            words = words[draw.randint(0, 30) : len(words) - draw.randint(0, 30)]
            if draw.random() < 0.3:
                words[draw.randrange(len(words))] = "other"
            parts.append(draw.choice([" ", "\n", " \t"]).join(words))
            parts.append(prose(draw.randint(0, 20)))
        rows.append((doc_id, " ".join(parts)))
    expected = brute_force(rows)
    assert sum(r[2] > 0 for r in expected) > 20
    assert result(frame(rows)) == expected


def test_test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == brute_force(rows)


def test_edge_cases(frame, prose):
    text, long = prose(70), prose(20000, "long")
    same = "again " * 130
    rows = [
        (4, None), (5, ""), (6, " \n"), (7, text), (8, text), (8, text), (None, text), (None, None),
        (9, "a " + text), (10, text[: len(text) // 2]), (11, long), (12, "x " + long),
        (13, same), (14, same + "b"), (15, text.upper()), (1, "é " * 49), (2, "é " * 50), (3, "é " * 51),
    ]
    assert result(frame(rows)) == brute_force(rows)


def test_spans_are_maximal(frame, prose):
    first, second = prose(60), prose(55)
    rows = [(1, first), (2, second), (3, f"{first} a {second} b {first} {second}")]
    found = {r.doc_id: r for r in op.cut_repeats(frame(rows)).collect()}
    assert [tuple(s) for s in found[3].repeats] == [(0, 60), (61, 116), (117, 232)]
    assert found[3].kept_text == "a b"


def test_empty_table(frame):
    assert op.cut_repeats(frame([])).collect() == []
