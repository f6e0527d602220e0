r"""Importance resampling towards a target distribution.

Texts are turned into bags of hashed n-grams.  All characters that part words
become single spaces; then a regular expression is searched with overlaps, its
look-arounds holding it to whole words, so each match is the span of one n-gram
and is hashed where it stands, without a list of words.

A bucket's gain is how much more often it is hit in the target than in the
documents.  A document's weight is the sum of the gains of its n-grams, and
noise from a hash of its id is added (the Gumbel trick), so that the highest scores
are a draw without replacement, in proportion to the importance weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import prepare, stored

ORDERS = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
# A-Z are lower-cased, other characters part words.
_TABLE = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256)
)


def spaced(text: bytes | None) -> bytes:
    """A text (UTF-8) as lower-case words with one space between."""
    return re.sub(rb" +", b" ", (text or b"").translate(_TABLE)).strip(b" ")


def runs(order: int) -> regex.Pattern:
    """Matches ``order`` consecutive words, whole ones."""
    return regex.compile(rb"(?<![^ ])" + rb"[^ ]+ " * (order - 1) + rb"[^ ]+(?![^ ])")


def bucket_numbers(text: bytes, pattern: regex.Pattern, buckets: int) -> np.ndarray:
    """The bucket of every match, in order."""
    spans = pattern.finditer(text, overlapped=True)
    crc = np.fromiter((zlib.crc32(span[0]) for span in spans), np.int64)
    return crc % buckets


def _totals(orders: int, buckets: int) -> Callable:
    patterns = [runs(n) for n in range(1, orders + 1)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                text = spaced(text)
                for pattern in patterns:
                    totals += np.bincount(
                        bucket_numbers(text, pattern, buckets), minlength=buckets
                    )
        hit = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit), pa.array(totals[hit])], names=["bucket", "n"]
        )

    return counted


def bucket_counts(texts: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all ``texts`` (column ``text``) hit each bucket: tasks
    count, and a row for each bucket reaches the driver."""
    prepare(texts.sparkSession)
    rows = (
        texts.select(F.col("text").cast("string").cast("binary").alias("text"))
        .mapInArrow(_totals(orders, buckets), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n"))
    )
    totals = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():
        totals[bucket] = n
    return totals


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over raw frequency, smoothed by one
    for each bucket; rounded down."""
    s, t = float(raw.sum() + len(raw)), float(target.sum() + len(target))
    ratio = [((b + 1.0) * s) / ((a + 1.0) * t) for a, b in zip(raw, target, strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weights(gain: np.ndarray, orders: int) -> Callable:
    patterns = [runs(n) for n in range(1, orders + 1)]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch["text"].to_pylist():
                text = spaced(text)
                found = [bucket_numbers(text, pattern, len(gain)) for pattern in patterns]
                words.append(len(found[0]))
                features.append(sum(map(len, found)))
                weights.append(sum(int(gain[b].sum()) for b in found))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, pa.int64()) for c in (words, features, weights)]],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weighed


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw, fixed for seed and id; rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scores(
    docs: DataFrame, gain: np.ndarray, orders: int = ORDERS, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    prepare(docs.sparkSession)
    return (
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("text").cast("string").cast("binary").alias("text"),
        )
        .mapInArrow(
            _weights(gain, orders), "doc_id long, n_words long, n_features long, weight long"
        )
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    )


def drawn(scored: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of ``scored`` with their ``rank`` by score, from 1, or null beyond
    ``percent`` of them.

    Rows are dealt out by ranges of scores and numbered inside each range; the
    ranges' sizes, one number for each partition, give the ranks before it.
    """
    spark = scored.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = stored(
        scored.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        # The partition's number, and below 33 bits the row's in it.
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("range", F.shiftright("place", 33))
    )
    sizes = dict(numbered.groupBy("range").count().collect())
    before, starts = 0, []
    for number in sorted(sizes):
        starts.append((number, before))
        before += sizes[number]
    last = percent * before // 100
    starts = spark.createDataFrame(starts, "range long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return (
        numbered.join(F.broadcast(starts), "range")
        .withColumn("rank", F.when(rank <= last, rank))
        .select(*scored.columns, "rank")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    orders: int = ORDERS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs``
    (``doc_id``, ``text``), resampled towards the texts of ``target`` (``text``);
    other columns do not matter.

    ``rank`` counts the drawn rows from the highest score, equal scores by id
    (a null id last), and is null for the others.  Rows of fewer than
    ``least_words`` words are scored but never drawn.  Null and empty texts have
    no n-grams and weigh 0.  Rows that repeat are drawn like others.  An empty
    target favours rare buckets; no rows give no rows.
    """
    gain = gains(bucket_counts(docs, orders, buckets), bucket_counts(target, orders, buckets))
    scored = stored(scores(docs, gain, orders, seed))
    long = F.col("n_words") >= least_words
    short = scored.where(~long).withColumn("rank", F.lit(None).cast("long"))
    return (
        drawn(scored.where(long), percent)
        .unionByName(short)
        .select("doc_id", "n_features", "weight", "score", "rank")
    )
