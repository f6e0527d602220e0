import dataclasses
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_filter as op
from tidemark.llm.stored import stored

PAGES = "page_id long, url string, html string, host string, words string"


@pytest.fixture(scope="module")
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "own", "own") for r in rows], PAGES)


@pytest.mark.parametrize(
    "url, expected",
    [
        (None, ("", "")),
        ("", ("", "")),
        ("example.org/fr/", ("", "")),
        ("https://WWW.Example.ORG/Fr/x?a#b", ("www.example.org", "/Fr/x")),
        ("http://a.net", ("a.net", "")),
        ("http://a.net?b/c", ("a.net", "")),
        ("http://a.net#b/c", ("a.net", "")),
        ("x://y://z/w", ("y:", "//z/w")),
        ("http://ÉXAMPLE.com/é", ("Éxample.com", "/é")),
        ("://", ("", "")),
    ],
)
def test_host_and_path(url, expected):
    assert op.host_and_path(url) == expected


@pytest.mark.parametrize(
    "host, path, rule",
    [
        ("a.net", "/", "net/"),
        ("net", "/x", "net/"),
        ("anet", "/", None),
        ("a.net", "", None),
        ("www.example.net", "/en/1", "example.net/en/"),
        ("www.example.net", "/en", "net/"),
        ("myexample.net", "/en/1", "net/"),
        ("b.example.com", "/de/", "example.com/de/"),
        ("b.example.com", "/de", None),
        ("x.org", "/fr/a", "org/fr/"),
        ("", "", None),
        ("", "/fr/", None),
    ],
)
def test_longest_rule_wins(host, path, rule):
    found = op.RuleSet(op.RULES).match(host, path)
    assert (found and found.text) == rule


def known_parts(label, counts):
    spans = [(i, j) for j in range(1, len(label) + 1) for i in range(j)]
    return [(i, j, counts[label[i:j]]) for i, j in spans if label[i:j] in counts]


def test_viterbi_equals_trying_all_splits():
    counts = {"the": 90, "rapist": 3, "therapist": 1, "he": 40, "rap": 5, "is": 50, "t": 9}

    def cost(parts):
        return sum(
            math.log(1000 / counts[p]) if p in counts else op.unknown_cost(len(p), 1000)
            for p in parts
        )

    def splits(text):
        yield [text]
        for i in range(1, len(text)):
            for rest in splits(text[i:]):
                yield [text[:i], *rest]

    for label in ("therapist", "theistherap", "qqthe", "x", "thetheis"):
        found = op.segment(label, known_parts(label, counts), 1000)
        assert "".join(found) == label
        assert cost(found) == pytest.approx(min(map(cost, splits(label))))
    # Beyond what a host may have: still whole, and cut where words are known.
    long = "the" * 40
    assert op.segment(long, known_parts(long, counts), 1000) == ["the"] * 40


def plain(rows):
    """Words, verdict and score of every url, by counting in one place."""
    rules, ignored = op.RuleSet(op.RULES), op.RuleSet(op.RULES).words()
    counts = Counter()
    for _, _, html in rows:
        counts.update(re.findall("[a-z]+", re.sub("<[^>]*>", " ", (html or "").lower())))
    total = max(sum(counts.values()), 1)
    for seed in op.SEEDS:
        counts[seed] = max(counts[seed], max(1, round(op.SEED_SHARE * total)))
    counts = {w: n for w, n in counts.items() if len(w) <= op.LABEL_LETTERS}
    judged, seen, sums = [], Counter(), [0, 0]
    classes = {True: Counter(), False: Counter()}
    for _, url, _ in rows:
        host, path = op.host_and_path(url)
        rule = rules.match(host, path)
        own = [
            w
            for label in op.host_labels(host)
            for w in op.segment(label, known_parts(label, counts), total)
            if w not in ignored
        ]
        blocked = rule.verdict == op.BLOCK if rule else bool(set(own) & set(op.SEEDS))
        words = own + op.path_words(path, ignored)
        judged.append((rule, words))
        classes[blocked].update(words)
        if not rule:
            seen[blocked] += 1
    sums = {b: sum(c.values()) for b, c in classes.items()}
    of = math.log((sums[False] + 0.5) / (sums[True] + 0.5))

    def odds(word):
        ratio = (classes[True][word] + 0.5) / (classes[False][word] + 0.5)
        return (math.log(ratio) + of) * 1e6

    prior = math.log((seen[True] + 1) / (seen[False] + 1))
    found = []
    for rule, words in judged:
        score = prior + sum(round(odds(w)) for w in words) / 1e6
        found.append((words, rule.verdict if rule else "block" if score > 0 else "allow", score))
    return found


SF = "/root/testdata/sf0.001/pages.parquet"


def test_equals_counting_in_one_place(spark):
    pages = spark.read.parquet(SF)
    rows = [(r.page_id, r.url, r.html) for r in pages.orderBy("page_id").collect()]
    found = op.filter_urls(pages, op.train(pages)).orderBy("page_id").collect()
    for row, (words, verdict, score) in zip(found, plain(rows), strict=True):
        assert (row.words, row.verdict) == (words, verdict)
        assert row.score == pytest.approx(score, abs=2e-5)


def test_seeded_urls_are_blocked_through_the_words_beside(spark):
    """With seeds taken out of what is scored, most seeded urls are still blocked, and
    other urls are not."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    model = op.train(pages)
    odds = model.odds.where(~F.col("word").isin(*op.SEEDS))
    for model in (model, dataclasses.replace(model, odds=stored(odds))):
        found = op.filter_urls(pages, model).where("rule is null")
        seeded = F.arrays_overlap("words", F.array(*map(F.lit, op.SEEDS)))
        blocked = F.count_if(F.col("verdict") == "block")
        rows = {
            r.seeded: (r.blocked, r.n)
            for r in found.groupBy(seeded.alias("seeded"))
            .agg(blocked.alias("blocked"), F.count(F.lit(1)).alias("n"))
            .collect()
        }
        assert rows[True][1] > 50 and rows[True][0] >= 0.9 * rows[True][1]
        assert rows[False][0] <= 0.01 * rows[False][1]


def test_judges_every_row(spark, pages):
    text = "<p>pills and the garden news of our town, garden tools</p>" * 20
    rows = [(i, f"http://gardennews{i % 3}.example.com/en/{i}", text) for i in range(30)]
    rows += [(100 + i, f"http://pillstore.example.net/fr/{i}", text) for i in range(10)]
    rows += [
        (1000, "http://townpills24.example.com/en/1", None),
        (1001, "http://gardennews.example.com/en/1", ""),
        (1002, None, None),
        (1003, "no url", text),
        (None, "http://x.net/", None),
        (1004, "http://gardennews.example.org/fr/1", None),
        (1004, "http://gardennews.example.org/fr/1", None),
        (1005, "http://" + "a" * 500 + ".com/" + "b" * 100000, "x" * 100000),
    ]
    df = pages(rows)
    found = op.filter_urls(df, op.train(df)).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert by_id[1000].words[:2] == ["town", "pills"] and by_id[1000].verdict == "block"
    assert by_id[1001].words == ["garden", "news"] and by_id[1001].verdict == "allow"
    assert by_id[3].words == ["garden", "news"] and by_id[3].verdict == "allow"
    assert by_id[100].verdict == "block" and by_id[100].rule == "net/"
    nothing = by_id[1002]
    assert (nothing.host, nothing.path, nothing.rule, nothing.verdict) == ("", "", None, "allow")
    assert by_id[None].verdict == "block" and by_id[1004].verdict == "allow"


def test_empty_table(pages):
    df = pages([])
    assert op.filter_urls(df, op.train(df)).collect() == []
