"""Resampling against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm.importance_resampling import bucket_numbers, resample, runs, spaced

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, orders):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    found = [
        " ".join(words[i : i + n]) for n in range(1, orders + 1) for i in range(len(words) - n + 1)
    ]
    return len(words), [zlib.crc32(f.encode()) for f in found]


def plain(rows, target, orders=1, buckets=10000, percent=10, least=20):
    raw, aim = Counter(), Counter()
    bags = [features(text, orders) for _, text in rows]
    for _, bag in bags:
        raw.update(c % buckets for c in bag)
    for text in target:
        aim.update(c % buckets for c in features(text, orders)[1])
    s, t = sum(raw.values()), sum(aim.values())
    scored = []
    for (doc_id, _), (words, bag) in zip(rows, bags, strict=True):
        weight = sum(
            math.floor(
                1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))
            )
            for b in (c % buckets for c in bag)
        )
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(bag), weight, weight + noise, words))
    able = sorted(
        (r for r in scored if r[4] >= least),
        key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]),
    )
    last = percent * len(able) // 100
    ranked = [(*r[:4], n if n <= last else None) for n, r in enumerate(able, 1)]
    return sorted([*ranked, *((*r[:4], None) for r in scored if r[4] < least)], key=repr)


def rows_of(n=150):
    draw = random.Random(3)
    words = [f"wo{i}É" if i % 9 == 0 else f"Word{i}" for i in range(200)]
    rows = [(i, "  ".join(draw.choices(words, k=draw.randint(1, 70)))) for i in range(n)]
    same = " ".join(words[:30])
    return rows + rows[:5] + [
        (1000, None),
        (1001, ""),
        (1002, "?!\x00 -"),
        (1003, same),
        (1004, same),
        (1005, ", ".join(words) * 300),
        (None, same),
    ]


TARGET = ["word1 word2 word3 " * 30, None, "", "wo9É word10"]


@pytest.fixture(scope="module")
def make(spark):
    def frames(rows, target):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        docs = docs.selectExpr("*", "'own' as score", "1 as rank", "2 as place", "3 as n_words")
        return docs, spark.createDataFrame([(t,) for t in target], "text string")

    return frames


@pytest.mark.parametrize(
    "options",
    [{}, {"orders": 3, "buckets": 50}, {"percent": 100, "least": 1}, {"percent": 0}],
)
def test_equals_a_plain_computation(make, options):
    rows = rows_of()
    given = {("least_words" if k == "least" else k): v for k, v in options.items()}
    found = sorted(map(tuple, resample(*make(rows, TARGET), **given).collect()), key=repr)
    assert found == plain(rows, TARGET, **options)


def test_no_rows(make):
    assert resample(*make([], TARGET)).count() == 0
    rows = rows_of(30)
    found = sorted(map(tuple, resample(*make(rows, [])).collect()), key=repr)
    assert found == plain(rows, [])


def test_matches_are_whole_words():
    text = spaced(" One,two--THREE\tfour ".encode())
    assert text == b"one two three four"
    spans = [m.span() for m in runs(2).finditer(text, overlapped=True)]
    assert [text[a:b] for a, b in spans] == [b"one two", b"two three", b"three four"]
    assert len(bucket_numbers(text, runs(5), 10)) == 0
