import itertools
import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use for themselves.
CLASHING = ["words", "term", "pos", "start", "component", "head", "rank", "shard", "epoch", "_doc"]


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from ``(doc_id, text)`` or ``(doc_id, text, source)`` rows,
    with columns whose names operators use inside."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or "")) for r in rows
        ]
        df = spark.createDataFrame(full, DOCUMENT)
        for name in CLASHING:
            df = df.selectExpr("*", f"'own' as {name}")
        return df

    return make


@pytest.fixture
def prose():
    """Invented prose: ``prose(n)`` gives n words, the same for the same seed."""
    numbers = itertools.count()

    def make(n, seed=None):
        draw = random.Random(f"prose {next(numbers) if seed is None else seed}")
        syllables = ["ba", "do", "ki", "lu", "me", "no", "ri", "sa", "te", "vo", "xi", "zu"]
        return " ".join("".join(draw.choices(syllables, k=draw.randint(2, 4))) for _ in range(n))

    return make
