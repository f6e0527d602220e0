"""The audit against exact arithmetic over all terms, and digests that collide."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import source_audit
from tidemark.llm.source_audit import audit, pieces

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(rows, least_docs=3, ranks=200):
    texts = [(lang or "", source or "", terms(text)) for text, lang, source in rows]
    found = []
    for lang in {r[0] for r in texts}:
        own = [(s, t) for l, s, t in texts if l == lang]
        in_docs = Counter(term for _, t in own for term in set(t))
        kept = {term for term, n in in_docs.items() if n >= least_docs}
        uses = defaultdict(Counter)
        for source, t in own:
            uses[source].update(term for term in t if term in kept)
        whole = sum(uses.values(), Counter())

        def share(counts):
            size = sum(counts.values()) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // size for t in kept}

        p, q = {s: share(c) for s, c in uses.items()}, share(whole)
        for source in p:
            pair = [
                (-sum((p[source][t] - o[t]) ** 2 // o[t] for t in kept), other)
                for other, o in p.items()
                if other != source
            ]
            term = [
                (-((p[source][t] - q[t]) ** 2 // q[t]), t)
                for t in kept
                if uses[source][t] and p[source][t] > q[t]
            ]
            for part, values in (("pair", sorted(pair)), ("term", sorted(term)[:ranks])):
                found += [(lang, source, part, i, -v, n) for n, (v, i) in enumerate(values, 1)]
    return sorted(found)


def rows_of(seed, n=120):
    draw = random.Random(seed)
    words = ["w" + "abcdefghij"[i % 10] + "klmnop"[i % 6] + "é" * (i % 7 == 0) for i in range(60)]
    shares = [1 / (i + 1) for i in range(60)]
    rows = []
    for i in range(n):
        source = draw.choice(["hot"] * 6 + ["b", "c", "d", None, ""])
        lang = draw.choice(["en", "en", "de", None])
        text = " ".join(draw.choices(words, shares, k=draw.randint(0, 80)))
        rows.append((text.title() if i % 5 == 0 else text, lang, source))
    return rows + rows[:10] + [
        (None, "en", "nothing"),
        ("", "en", "b"),
        ("1 2 3", "en", "digits"),
        ("Once upon", "xx", "only"),
        ("once", "xx", "other"),
        ("longword " * 20000, "de", "hot"),
        ("ÄÖ Äö K ſ \x00nul\x7fdel", "de", "c"),
    ]


@pytest.fixture(scope="module")
def make(spark):
    def frame(rows):
        df = spark.createDataFrame(rows, "text string, lang string, source string")
        return df.selectExpr("*", "1 as digest", "2 as n", "'own' as term", "3 as split", "4 as p")

    return frame


@pytest.mark.parametrize("bits", [64, 3])
def test_equals_exact_arithmetic(make, bits):
    """With three bits most terms share a digest, and are told apart."""
    rows = rows_of(5)
    found = sorted(map(tuple, audit(make(rows), bits=bits).collect()))
    assert found == plain(rows)


def test_few_ranks_with_ties(make):
    rows = [(" ".join(f"t{c}" for c in "abcdefgh"), "en", "a")] * 3 + [("tz " * 9, "en", "b")] * 3
    found = sorted(map(tuple, audit(make(rows), ranks=3).collect()))
    assert found == plain(rows, ranks=3)
    assert [r[3] for r in found if r[1:3] == ("a", "term")] == ["ta", "tb", "tc"]


def test_no_kept_term(make):
    found = sorted(map(tuple, audit(make([("a b", "en", "x"), ("c", "en", "y")])).collect()))
    assert found == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_no_rows(make):
    assert audit(make([])).count() == 0


def test_only_kept_terms_have_their_strings_compared(make):
    docs = make(rows_of(7))
    for bits, shared in ((64, False), (3, True)):
        occur = source_audit.occurrences(source_audit.tallies(docs, bits), 3)
        names = source_audit.dictionary(docs, occur.select("lang", "digest"), bits)
        assert names.count() == occur.count()
        assert bool(names.where("low <> high").count()) == shared


def test_shares_of_huge_counts(spark):
    cases = [(n, 10**18, 12345) for n in (0, 9 * 10**9, 2**63 // 10**9 - 2, 10**12, 10**18)]
    rows = spark.createDataFrame(cases, "n long, total long, kept long")
    found = [r[0] for r in rows.select(source_audit.smoothed("n", "total", "kept")).collect()]
    assert found == [1 + 10**9 * (n + 1) // (total + kept) for n, total, kept in cases]


def test_pieces_cut_no_term(monkeypatch):
    monkeypatch.setattr(source_audit, "PIECE", 7)
    text = "One twothreefour é" * 20 + "x" * 50
    joined = [t for piece in pieces(text.encode()) for t in piece]
    assert joined == [t.encode() for t in terms(text)]
