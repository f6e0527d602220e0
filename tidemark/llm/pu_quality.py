"""Quality scores by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1.  The unlabelled texts are a
sample of all documents, labelled or not, and no label of theirs is looked at, so
they hold positives and negatives as the web does.  The class prior is estimated from
the two (the smallest ratio of unlabelled to positive mass among the highest
scores), and a small network minimises the non-negative unbiased risk

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)]),

undoing a step whenever the second part falls below zero.  Negative labels are
never used.  The fit sees at most ``POSITIVES`` and ``UNLABELLED`` documents, chosen
by a hash of their ids among those of the training folds, one row of each; every
text is then scored whole, in tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import prepare

# Bounds of the sample the model is fitted on.
POSITIVES = 4000
UNLABELLED = 8000
FOLDS = 5
THRESHOLD = 0.3

HIDDEN = 24
STEPS = 1500
BATCH = 512
RATE = 0.01
DECAY = 1e-4
CLIP = 6.0

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER_OR_OTHER = np.zeros(256, bool)
_LOWER_OR_OTHER[97:123] = True
_LOWER_OR_OTHER[0xC3:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(rb"#*$%&|<>@^_~{}\\=+[]/")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?")] = True

FEATURES = (
    "log_words",
    "word_length",
    "distinct",
    "most_common",
    "same_as_previous",
    "repeated_windows",
    "upper",
    "digit",
    "symbol",
    "stop",
    "exclamation",
    "pipe",
    "repeated_lines",
    "short_lines",
    "symbol_lines",
    "upper_lines",
)


def features(text: str | None) -> np.ndarray:
    """Shares that do not depend on language, source or id."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return out
    n = len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = counts[_UPPER].sum() + counts[_LOWER_OR_OTHER].sum() + 1
    common = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    # Shares of words in lines that look like a table, a banner or a list.
    short = symbol = upper = 0
    for line in lines:
        size = line.count(b" ") + 1
        short += size < 5
        marks = sum(map(line.count, (b"|", b"#", b"*", b"$", b"%", b"&", b"<", b">")))
        symbol += size * (2 * marks > size)
        upper += size * (line.isupper())
    out[:] = (
        np.log1p(n),
        len(raw) / n,
        len(common) / n,
        common.most_common(1)[0][1] / n,
        sum(map(eq, words, words[1:])) / n,
        1 - (len(set(zip(words, words[1:], words[2:]))) + 1) / (max(0, n - 2) + 1),
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / len(raw),
        counts[_SYMBOL].sum() / n,
        counts[_STOP].sum() / n,
        counts[33] / n,
        counts[124] / n,
        1 - len(set(lines)) / len(lines),
        short / len(lines),
        symbol / n,
        upper / n,
    )
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of quality 1, for rows of features."""
        return 1 / (1 + np.exp(-_forward(self.weights, self._scaled(rows))[0]))

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.spread, -CLIP, CLIP)


def _forward(weights, rows):
    first, bias, second, offset = weights
    hidden = np.tanh(rows @ first + bias)
    return np.clip(hidden @ second + offset, -30, 30), hidden


def _backward(weights, rows, hidden, slope):
    """Gradients, given the slope of the risk in each row's output."""
    first, _, second, _ = weights
    inner = slope[:, None] * second * (1 - hidden**2)
    return rows.T @ inner, inner.sum(axis=0), hidden.T @ slope, slope.sum()


def risk(
    weights, p: np.ndarray, u: np.ndarray, prior: float
) -> tuple[float, float, list[np.ndarray]]:
    """The non-negative risk on rows ``p`` (positive) and ``u`` (unlabelled); what a step
    lowers, and its gradients.  That is the risk, or, where its second part is below
    zero, that part's distance from zero.  A prior of 0 asks for the plain separation
    of the two."""
    out_p, hidden_p = _forward(weights, p)
    out_u, hidden_u = _forward(weights, u)
    sure_p, sure_u = 1 / (1 + np.exp(-out_p)), 1 / (1 + np.exp(-out_u))
    n, m = len(p), len(u)
    # Means of log(1 + exp(-f)) and log(1 + exp(f)), and slopes of what is lowered.
    positive, negative = np.logaddexp(0, -out_p).mean(), np.logaddexp(0, out_u).mean()
    if prior:
        positive, negative = prior * positive, negative - prior * np.logaddexp(0, out_p).mean()
        value = lowered = positive + max(0.0, negative)
        if negative >= 0:
            slope_p, slope_u = (prior * (sure_p - 1) - prior * sure_p) / n, sure_u / m
        else:
            # Overfitted: only raise the negative part again.
            lowered = -negative
            slope_p, slope_u = prior * sure_p / n, -sure_u / m
    else:
        value = lowered = positive + negative
        slope_p, slope_u = (sure_p - 1) / n, sure_u / m
    gradients = [
        a + b
        for a, b in zip(
            _backward(weights, p, hidden_p, slope_p),
            _backward(weights, u, hidden_u, slope_u),
            strict=True,
        )
    ]
    return value, lowered, gradients


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, ...]:
    """The network of least non-negative risk; a prior of 0 asks for the plain
    separation of positive from unlabelled rows."""
    draw = np.random.Generator(np.random.PCG64(7))
    width = positive.shape[1]
    weights = [
        draw.normal(0, 1 / np.sqrt(width), (width, HIDDEN)),
        np.zeros(HIDDEN),
        draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(()),
    ]
    moment = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        p = positive[draw.integers(0, len(positive), BATCH)]
        u = unlabelled[draw.integers(0, len(unlabelled), BATCH)]
        _, _, gradients = risk(weights, p, u, prior)
        rate = RATE * (1 - (step - 1) / STEPS)
        for i, gradient in enumerate(gradients):
            gradient = gradient + DECAY * weights[i]
            moment[i] = 0.9 * moment[i] + 0.1 * gradient
            square[i] = 0.999 * square[i] + 0.001 * gradient**2
            ahead = moment[i] / (1 - 0.9**step)
            weights[i] = weights[i] - rate * ahead / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(weights)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled scores: where scores are highest only
    positives are left, so the ratio of the two masses there is the share.  Its
    smallest upper bound over all thresholds is taken."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    at = np.unique(np.quantile(positive, np.linspace(0, 0.9, 91)))
    mass_p = np.array([(positive >= t).mean() for t in at])
    mass_u = np.array([(unlabelled >= t).mean() for t in at])
    slack = np.sqrt(np.log(40) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(np.argmin((mass_u + slack) / mass_p))
    return float(np.clip(mass_u[best] / mass_p[best], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model | None:
    """A model from rows of features; none if either side is empty."""
    if not len(positive) or not len(unlabelled):
        return None
    mean, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-6
    start = Model(mean, spread, (), 0.5)
    p, u = start._scaled(positive), start._scaled(unlabelled)
    # The prior is estimated on the half the plain model has not seen.
    plain = _fit(p[::2], u[::2], 0.0)
    prior = estimate_prior(_forward(plain, p[1::2])[0], _forward(plain, u[1::2])[0])
    return Model(mean, spread, _fit(p, u, prior), prior)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(text.as_py()).tolist() for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["trusted"],
                batch["any"],
                pa.array(rows, pa.list_(pa.float64())),
            ],
            names=["doc_id", "trusted", "any", "row"],
        )


def training_rows(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> tuple[np.ndarray, np.ndarray]:
    """Features of trusted positives and of unlabelled documents, of the training
    folds: one row for each of at most so many ids (of rows with the same id, the
    least by features).  Labels that are null, or name no document, do not count."""
    prepare(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    trained = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    good = labels.select(doc_id, F.col("quality").cast("int").alias("quality"))
    texts = docs.select(doc_id, F.col("text").cast("string").alias("text")).where(trained)

    def sample(rows: DataFrame, size: int, salt: str) -> DataFrame:
        order = F.xxhash64("doc_id", F.lit(salt))
        return rows.select("doc_id").distinct().orderBy(order, "doc_id").limit(size)

    trusted = sample(good.where(trained & (F.col("quality") == 1)), positives, "positive")
    every = sample(texts, unlabelled, "unlabelled")
    chosen = (
        trusted.select("doc_id", F.lit(1).alias("trusted"), F.lit(0).alias("any"))
        .union(every.select("doc_id", F.lit(0), F.lit(1)))
        .groupBy("doc_id")
        .agg(F.max("trusted").alias("trusted"), F.max("any").alias("any"))
    )
    # At most positives + unlabelled ids, and as many rows.
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "trusted", "any", "text")
        .mapInArrow(_measure, "doc_id long, trusted int, any int, row array<double>")
        .groupBy("doc_id", "trusted", "any")
        .agg(F.min("row").alias("row"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])

    def table(flag: str) -> np.ndarray:
        return np.array([r["row"] for r in rows if r[flag]]).reshape(-1, len(FEATURES))

    return table("trusted"), table("any")


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the training folds of ``docs`` (``doc_id``, ``text``) and ``labels``
    (``doc_id``, ``quality``); none where one side has no row.  See
    ``training_rows`` for nulls and repeated ids."""
    return fit(*training_rows(docs, labels))


def _scores(texts: pa.Array, model: Model | None) -> np.ndarray:
    rows = np.array([features(t.as_py()) for t in texts]).reshape(-1, len(FEATURES))
    value = model.score(rows) if model else np.full(len(rows), 0.5)
    return np.where(rows[:, 0] > 0, value, 0.0)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``
    (``doc_id``, ``text``; other columns do not matter).

    Texts without a word score 0.  Without a model every other text scores 0.5.
    Repeated rows score alike; a null id is not held out.
    """
    prepare(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = _scores(batch["text"], model)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(value, pa.float64())], names=["doc_id", "score"]
            )

    scores = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scored, "doc_id long, score double"
    )
    return scores.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are predicted 1: one pass
    over the documents and no join."""
    prepare(docs.sparkSession)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = _scores(batch["text"], model)
            yield batch.filter(pa.array(value >= THRESHOLD))

    return docs.mapInArrow(good, docs.schema)
