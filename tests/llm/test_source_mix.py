import math
from collections import Counter, defaultdict

import pytest

from tidemark.llm import source_mix as op


def corpus(prose):
    rows, doc_id = [], 0
    for source, n in (("big", 200), ("mid", 60), ("small", 20), (None, 30)):
        for _ in range(n):
            rows.append((doc_id, prose(10 + doc_id % 40), source))
            doc_id += 1
    return [*rows, (900, None, "small"), (901, "", "mid"), (None, "no id here", "mid")]


def test_weights_and_budgets(frame, prose):
    rows = corpus(prose)
    copies = op.mix(frame(rows)).collect()
    tokens, taken, count = Counter(), Counter(), Counter()
    for doc_id, text, source in rows:
        tokens[source] += max(1, len((text or "").split()))
    for r in copies:
        taken[r.source] += r.n_tokens
        count[r.doc_id, r.epoch] += 1
    total = sum(tokens.values())
    alpha = 1 - math.log(2) / math.log(max(tokens.values()) / min(tokens.values()))
    alpha = math.ceil(round(alpha * 1e4, 3)) / 1e4
    power = {s: (n / total) ** alpha for s, n in tokens.items()}
    weight = {r.source: r.weight for r in copies}
    for s in tokens:
        assert weight[s] == pytest.approx(power[s] / sum(power.values()), abs=1e-8)
        budget = round(power[s] * max(tokens[x] / power[x] for x in tokens))
        # Budgets are met but for what the next document would overrun.
        assert budget - 60 <= taken[s] <= budget
        assert tokens[s] <= budget <= 2.001 * tokens[s]
    # Everything once, nothing twice in an epoch.
    assert {d for d, e in count if e == 0} == {r[0] for r in rows}
    assert set(count.values()) == {1}


def test_positions_interleave_sources_at_their_weights(frame, prose):
    copies = op.mix(frame(corpus(prose))).collect()
    total = sum(r.n_tokens for r in copies)
    for low, high in ((0.0, 0.5), (0.25, 0.75)):
        part = defaultdict(int)
        for r in copies:
            if low <= r.position < high:
                part[r.source] += r.n_tokens
        for source, n in part.items():
            weight = next(r.weight for r in copies if r.source == source)
            assert n / sum(part.values()) == pytest.approx(weight, abs=0.06)
    assert total > 0


def test_target_entropy(spark):
    sources = spark.createDataFrame([("a", 800), ("b", 150), ("c", 50)], "source string, tokens long")
    for target in (0.7, 0.9, 1.05):
        alpha = op.exponent(sources, None, target)
        power = [(n / 1000) ** alpha for n in (800, 150, 50)]
        shares = [p / sum(power) for p in power]
        assert -sum(s * math.log(s) for s in shares) == pytest.approx(target, abs=1e-3)
    # Not even the corpus as it is has so little.
    assert op.exponent(sources, None, 0.1) == 1.0
    # Even sources are not repeated.
    assert op.exponent(sources, 100.0) == 0.0


def test_edge_cases(frame, prose):
    assert op.mix(frame([])).collect() == []
    one = op.mix(frame([(1, "a b c", "x"), (2, None, "x")])).collect()
    assert sorted((r.doc_id, r.epoch, r.weight) for r in one) == [(1, 0, 1.0), (2, 0, 1.0)]
    # A repeated row is one document; ids may repeat with other texts.
    rows = [(1, "a b", "x"), (1, "a b", "x"), (1, "c", "x"), (3, prose(30000, "long"), "x")]
    assert sorted((r.doc_id, r.n_tokens) for r in op.mix(frame(rows)).collect()) == [(1, 1), (1, 2), (3, 30000)]


def test_rows_are_repeated_whole(frame, prose):
    rows = corpus(prose)
    df = frame(rows)
    mixed = op.mixed_rows(df)
    assert mixed.columns == df.columns
    found = Counter(r.doc_id for r in mixed.collect())
    wanted = Counter(r.doc_id for r in op.mix(df).collect())
    assert found == wanted
