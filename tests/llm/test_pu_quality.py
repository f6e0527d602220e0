import random
import zlib

import numpy as np
import pytest

from tidemark.llm import pu_quality as op


def junk(draw, prose):
    kind = draw.randrange(4)
    words = prose(draw.randint(30, 200)).split()
    if kind == 0:
        return " ".join(w for w in words[:8] for _ in range(20))
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 2:
        return " ".join(w + draw.choice("*#$%&") * 3 for w in words)
    return " | ".join(words)


@pytest.fixture(scope="module")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(prose, n=600):
    draw = random.Random(11)
    rows, marks = [], []
    for i in range(n):
        good = draw.random() < 0.7
        rows.append((i, prose(draw.randint(20, 200)) if good else junk(draw, prose)))
        marks.append((i, int(good), 0))
    return rows, marks


def test_held_out_accuracy_without_negative_labels(frame, labels, prose):
    rows, marks = corpus(prose)
    model = op.train(frame(rows), labels(marks))
    assert abs(model.prior - 0.7) < 0.1
    scores = {r.doc_id: r for r in op.score(frame(rows), model).collect()}
    truth = dict((i, q) for i, q, _ in marks)
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in scores.items() if r.held_out} == set(out)
    assert np.mean([scores[i].predicted == truth[i] for i in out]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in scores.values())
    # The columns that are no inputs do not matter.
    other = frame(rows).selectExpr("doc_id + 1 as doc_id", "text", "'de' as lang", "'x' as source")
    moved = {r.doc_id - 1: r.score for r in op.score(other, model).collect()}
    assert moved == {i: r.score for i, r in scores.items()}


def test_labels_of_the_held_out_fold_are_not_read(frame, labels, prose):
    rows, marks = corpus(prose, 300)
    flipped = [
        (i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in marks
    ]
    a, b = (op.train(frame(rows), labels(m)) for m in (marks, flipped))
    assert all(np.array_equal(x, y) for x, y in zip(a.weights, b.weights))


def test_edge_cases(frame, labels, prose):
    rows, marks = corpus(prose, 100)
    odd = [(1, None), (2, ""), (3, " \n"), (None, prose(30)), (4, prose(40000, "long")), (5, "x"), (5, "x")]
    model = op.train(frame(rows), labels([*marks, (None, 1, 0), (7, None, 0), (10**9, 1, 0)]))
    scores = [tuple(r) for r in op.score(frame(odd), model).collect()]
    assert len(scores) == 7 and all(0 <= s[2] <= 1 for s in scores)
    assert [s[2] for s in scores if s[0] in (1, 2, 3)] == [0, 0, 0]
    assert not next(s for s in scores if s[0] is None)[1]
    assert op.score(frame([]), model).collect() == []
    kept = op.keep_good(frame(odd), model)
    assert kept.columns == frame(odd).columns
    assert {r.doc_id for r in kept.collect()} == {s[0] for s in scores if s[3]}


def test_without_labels_nothing_is_learned(frame, labels, prose):
    model = op.train(frame([(1, prose(20))]), labels([]))
    assert model is None
    found = op.score(frame([(1, prose(20)), (2, None)]), model).collect()
    assert sorted((r.doc_id, r.score, r.predicted) for r in found) == [(1, 0.5, 1), (2, 0.0, 0)]


def test_prior_is_the_smallest_ratio():
    draw = np.random.Generator(np.random.PCG64(1))
    positive = draw.normal(2, 1, 4000)
    mixed = np.concatenate([draw.normal(2, 1, 2000), draw.normal(-2, 1, 2000)])
    assert abs(op.estimate_prior(positive, mixed) - 0.5) < 0.06


def test_unlabelled_texts_are_of_all_documents(frame, labels, prose):
    """One row for each id, also of ids that repeat, and of documents without labels."""
    rows, marks = corpus(prose, 300)
    some = [m for m in marks if m[0] % 3 == 0]
    positive, unlabelled = op.training_rows(frame(rows), labels(some))
    in_folds = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert len(unlabelled) == len(in_folds)
    assert len(positive) == len([m for m in some if m[1] == 1 and m[0] in in_folds])
    hot = next(i for i in in_folds if (i, 1, 0) in some)
    repeated = rows + [(hot, f"copy {n} of it") for n in range(5000)]
    positive, unlabelled = op.training_rows(frame(repeated), labels([*some, (hot, 0, 0)]))
    assert len(unlabelled) == len(in_folds)
    assert len(op.training_rows(frame(rows), labels(some), 20, 30)[1]) == 30


@pytest.mark.parametrize("prior, shift", [(0.0, 0.0), (0.3, 0.0), (0.6, 0.0), (0.9, 4.0)])
def test_risk_and_gradients(prior, shift):
    """Against the formula, and against finite differences; the last case has a negative
    part below zero."""
    draw = np.random.Generator(np.random.PCG64(5))
    p, u = draw.normal(0.5 + shift, 1, (40, 3)), draw.normal(-shift, 1, (70, 3))
    weights = [
        draw.normal(0.3, 1, (3, op.HIDDEN)),
        draw.normal(0, 1, op.HIDDEN),
        draw.normal(0.3, 1, op.HIDDEN),
        np.array(0.2),
    ]

    def output(weights, rows):
        return np.tanh(rows @ weights[0] + weights[1]) @ weights[2] + weights[3]

    def parts(weights):
        f, g = output(weights, p), output(weights, u)
        if not prior:
            return np.log1p(np.exp(-f)).mean(), np.log1p(np.exp(g)).mean()
        negative = np.log1p(np.exp(g)).mean() - prior * np.log1p(np.exp(f)).mean()
        return prior * np.log1p(np.exp(-f)).mean(), negative

    positive, negative = parts(weights)
    value, lowered, gradients = op.risk(weights, p, u, prior)
    assert (negative < 0) == (shift > 0)
    assert value == pytest.approx(positive + max(0, negative))
    assert lowered == pytest.approx(value if negative >= 0 else -negative)

    def objective(weights):
        positive, negative = parts(weights)
        return positive + negative if negative >= 0 else -negative

    for i, gradient in enumerate(gradients):
        for at in list(np.ndindex(weights[i].shape))[:10]:
            ends = []
            for step in (1e-6, -1e-6):
                moved = [w.copy() for w in weights]
                moved[i][at] += step
                ends.append(objective(moved))
            slope = (ends[0] - ends[1]) / 2e-6
            assert np.asarray(gradient)[at] == pytest.approx(slope, abs=1e-6, rel=1e-4)
