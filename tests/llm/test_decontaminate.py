import hashlib
import random
import re
from collections import Counter

import pytest

from tidemark.llm import decontaminate as op


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def by_proximity(own, w, counts):
    """Whether a window's rarest word has each other one at most two words from its place."""
    if not all(t in counts for t in w):
        return False
    _, first, at = min((counts[t], t.encode(), o) for o, t in enumerate(w))
    return any(
        all(t in own[max(0, p + o - at - 2) : max(0, p + o - at + 3)] for o, t in enumerate(w) if o != at)
        for p, word in enumerate(own)
        if word.encode() == first
    )


def brute_force(rows, items):
    out, counts = [], Counter(word for _, text in rows for word in words(text))
    for doc_id, text in rows:
        own, hit, ids, near = words(text), set(), set(), set()
        for item_id, wanted in items:
            w = words(wanted)
            n = min(10, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                if by_proximity(own, w[k : k + n], counts):
                    near.update([] if item_id is None else [str(item_id)])
                for i in range(len(own) - n + 1):
                    if own[i : i + n] == w[k : k + n]:
                        hit.update(range(i, i + n))
                        ids.update([] if item_id is None else [str(item_id)])
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(ids), digest, bool(hit), len(near)))
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def result(df, benchmark, limit=op.BROADCAST_BYTES):
    found = op.digest(op.contamination(df, benchmark, limit))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def altered(text, *places):
    """With a word put in at each place."""
    out = text.split()
    for place in places:
        out.insert(place, "odd")
    return " ".join(out)


def cases(prose):
    a, b = prose(25), prose(14)
    benchmark = [
        (1, a), (20, b.upper() + "!"), (3, "short one"), (4, "Éa b"), (5, None), (6, " .. "),
        (None, prose(12, "none")), (7, a), (8, "x x x x x x x x x x x x"),
    ]
    docs = [
        (1, f"{prose(30)} {a} {prose(5)}"), (2, f"y,{b}"), (3, "a SHORT-one."), (4, "éa b Éa b"),
        (5, None), (6, ""), (7, prose(40)), (8, prose(12, "none")), (None, a), (9, a), (9, a),
        (10, " ".join(a.split()[3:13])), (11, " ".join(a.split()[:9])), (12, "x " * 15), (13, "--"),
        (14, f"{prose(9)} {altered(a, 3, 9, 14, 20)} {prose(9)}"), (15, altered(a, 5, 12, 19)),
        (16, f"{prose(20000, 'long')} {b} {prose(500)} {altered(b, 4, 8)}"), (17, altered(b, 7)),
    ]
    return docs, benchmark


def test_equals_brute_force(frame, items, prose):
    docs, benchmark = cases(prose)
    expected = brute_force(docs, benchmark)
    assert sum(r[5] for r in expected) >= 9
    # Near, and not exact.
    assert sum(r[6] > r[3] for r in expected) >= 3
    assert result(frame(docs), items(benchmark)) == expected


def test_blocks_of_the_benchmark_give_the_same_rows(frame, items, prose):
    docs, benchmark = cases(prose)
    assert result(frame(docs), items(benchmark), limit=2000) == brute_force(docs, benchmark)


def test_empty_tables(frame, items, prose):
    docs, benchmark = cases(prose)
    assert result(frame([]), items(benchmark)) == []
    assert result(frame(docs), items([])) == brute_force(docs, [])


def test_stage_drops_contaminated_rows_only(frame, items, prose):
    docs, benchmark = cases(prose)
    df = frame(docs)
    kept = op.clean_rows(df, items(benchmark))
    assert kept.columns == df.columns
    clean = [r[0] for r in brute_force(docs, benchmark) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_index_finds_phrases_and_neighbours(frame):
    index = op.positional_index(
        frame([(1, "to be or not to be"), (2, "be to or"), (3, "not so"), (4, None)])
    ).cache()
    found = op.phrase_matches(index, ["to", "be"]).collect()
    assert sorted(map(tuple, found)) == [(1, 0), (1, 4)]
    assert op.phrase_matches(index, ["be", "so"]).collect() == []
    near = op.proximity_matches(index, ["or", "be"], 1).collect()
    assert sorted(map(tuple, near)) == [(1, 2)]
    assert sorted(map(tuple, op.proximity_matches(index, ["or", "be"], 2).collect())) == [(1, 2), (2, 2)]


def test_benchmark_of_common_words(frame, items):
    draw, common = random.Random(5), [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(draw.choices(common, k=60))) for i in range(120)]
    benchmark = [(i, " ".join(draw.choices(common, k=30))) for i in range(20)]
    docs += [(1000, f"w1 {benchmark[3][1]} w2"), (1001, altered(benchmark[4][1], 12))]
    df, wanted = frame(docs), items(benchmark)
    assert result(df, wanted) == brute_force(docs, benchmark)
    # Nearly every word of the documents is a term; lists of two terms meet once for
    # all windows that share them, and few windows are tried.
    named = op._documents(df)
    windows = op.item_windows(wanted).select("phrase", "size")
    plans = op.window_plans(named, windows, op.BROADCAST_BYTES).cache()
    vocabulary = plans.selectExpr("explode(plan.term) as term").distinct()
    lists = op._posting_lists(op._words(named), vocabulary, op.BROADCAST_BYTES).cache()
    tried = op.candidates(lists, plans, op.BROADCAST_BYTES)
    assert tried.count() < len(docs) * plans.count() / 4
