import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import minmax_dedup as op


def brute_force(rows, percent=85):
    """Components by comparing all sets of word shingles."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        size = min(5, len(words))
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1) if size}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for d, s in sets.items():
        for shingle in s:
            places[shingle].append(d)
    shared = Counter(pair for ids in places.values() for pair in combinations(sorted(ids), 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def result(df, percent=85):
    rows = op.near_duplicates(df, percent).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}


def families(prose, groups=6, size=14):
    """Copies of copies, each with a few words changed."""
    draw, rows = random.Random(5), []
    for _ in range(groups):
        members = [prose(120).split()]
        for _ in range(size):
            words = list(draw.choice(members))
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(len(words))] = prose(1)
            members.append(words)
        rows += [" ".join(words) for words in members]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [85, 80, 95])
def test_components_equal_brute_force(frame, prose, percent):
    rows = families(prose)
    assert result(frame(rows), percent) == brute_force(rows, percent)


def test_bands_follow_from_the_similarity():
    assert [op.band_rows(percent) for percent in (80, 85, 90)] == [5, 7, 8]
    for percent in (50, 80, 85, 99):
        rows = op.band_rows(percent)
        bands = 2 * op.PERMUTATIONS // rows
        assert (1 - (percent / 100) ** rows) ** bands <= op.MISSED


def template_pages(prose, n):
    """Pages of one template that differ by about a fifth: similar, but below 0.85."""
    shared = prose(160, "template").split()
    rows = []
    for i in range(n):
        own = prose(8, f"page {i}").split()
        words = list(shared)
        for j, word in enumerate(own):
            words.insert(10 + 18 * j, word)
        rows.append((i, " ".join(words)))
    return rows


def test_pages_of_one_template_do_not_all_meet(frame, prose, monkeypatch):
    pairs = []
    own = op.compared_pairs

    def counted(members, rare):
        found = own(members, rare)
        pairs.append((members.count(), found.count()))
        return found

    monkeypatch.setattr(op, "compared_pairs", counted)
    for n in (100, 400):
        rows = template_pages(prose, n)
        assert result(frame(rows)) == brute_force(rows)
    (few, few_pairs), (many, many_pairs) = pairs
    # Most pages are in buckets with others, and hardly any two are compared.
    assert few > 50 and many > 200
    assert few_pairs <= few and many_pairs <= many


def test_test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == brute_force(rows)


def test_edge_cases(frame, prose):
    long = prose(30000, "long")
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "two words"), (5, "TWO\twords"), (6, "two wörds"),
        (7, long), (8, long + " more"), (9, "É a b c d e"), (10, "é a b c d e"),
    ]
    expected = brute_force(rows)
    assert expected[5][1] == 4 and expected[8][1] == 7 and expected[10][1] == 10
    assert result(frame(rows)) == expected


def test_null_ids_repeated_rows_and_repeated_ids(frame, prose):
    text, other = prose(60), prose(60)
    rows = [(None, text), (3, text), (3, text), (2, other), (3, other), (9, other)]
    found = op.near_duplicates(frame(rows)).collect()
    by_id = defaultdict(set)
    for r in found:
        by_id[r.doc_id].add((r.component_id, r.kept))
    assert len(found) == 6
    assert by_id[None] == {(None, True)}
    # The two texts of 3 link it with 2, and all that 2 is linked with.
    assert by_id[2] == {(2, True)} and by_id[3] == {(2, False)} and by_id[9] == {(2, False)}


def test_empty_table(frame):
    assert op.near_duplicates(frame([])).collect() == []


def test_stage_keeps_columns_and_the_first_of_each_group(frame, prose):
    text = prose(80)
    df = frame([(5, text), (2, text + " end"), (7, prose(80)), (None, text)])
    kept = op.first_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [2, 7, None]


@pytest.mark.parametrize("shared", [20, 300, 2000])
def test_signature_estimates_similarity(shared):
    draw = np.random.Generator(np.random.PCG64(shared))
    both = draw.integers(0, 2**63, shared, dtype=np.uint64)
    extra = draw.integers(0, 2**63, 2 * (shared // 4), dtype=np.uint64)
    left = np.concatenate([both, extra[: shared // 4]])
    right = np.concatenate([both, extra[shared // 4 :]])
    permutations = op._factors()
    a, b = (op.signature(x, *permutations) for x in (left, right))
    true = shared / (shared + 2 * (shared // 4))
    assert abs((a == b).mean() - true) < 0.15


def test_bitmaps_never_differ_more_than_sets(prose):
    a = op.shingle_set(prose(200, 1))
    b = np.concatenate([a[20:], op.shingle_set(prose(40, 2))])
    differ = len(set(a.tolist()) ^ set(b.tolist()))
    x, y = op.flipped_bits(a), op.flipped_bits(b)
    assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= differ
