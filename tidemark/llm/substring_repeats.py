"""Exact substring dedup: seed and extend.

**Seeds.**  Of the ``SEED``-word sequences inside a window of ``WINDOW`` words the
one with the smallest hash is the window's anchor (winnowing), so equal windows
have equal anchors at equal places, wherever they occur.  Consecutive windows
that share an anchor form a run, about one row for 13 words.

**Join.**  Documents meet on anchors.  Anchors of one document only are dropped;
no pairs of documents are formed: a group is reduced to its smallest document.

**Extension.**  A run's words reach from its anchor as far both ways as windows
around the anchor can.  Runs with equal words are one form; all but the smallest
document's copy repeat it whole.  Where an anchor has several forms they agree
around it only for a part, so each form (once, from its smallest document) is
extended word by word: every window of it is looked up among the windows of
the anchor's other forms by 128 bits of its words.

Repeated windows of a document that overlap or touch merge to maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import prepare, stored
from tidemark.llm.words import Rolling, white_words, word_hashes

WINDOW = 50
SEED = 25

# A place: 23 bits that tell texts of one id apart, the word a run starts at, and
# how many windows it holds (at most WINDOW - SEED + 1).
_START_BITS, _COUNT_BITS = 32, 8

# Windows whose anchors are sought at once, which bounds a task's memory.
CHUNK = 1 << 15


def _text_bits(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) & 0x7FFFFF


def _place(text: str, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    head = np.int64(_text_bits(text) << (_START_BITS + _COUNT_BITS))
    return head | (starts.astype(np.int64) << np.int64(_COUNT_BITS)) | counts.astype(np.int64)


def _own_places(text: str, places: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of the places that belong to this text."""
    values = np.array(places or [], np.int64)
    values = values[values >> np.int64(_START_BITS + _COUNT_BITS) == _text_bits(text)]
    starts = (values >> np.int64(_COUNT_BITS)) & np.int64(2**_START_BITS - 1)
    return starts, values & np.int64(2**_COUNT_BITS - 1)


def anchor_runs(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``anchor, form, start, count`` of the runs of a document."""
    windows = len(hashes) - WINDOW + 1
    if windows <= 0:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    first, second = Rolling(hashes, 1), Rolling(hashes, 2)
    at = np.arange(len(hashes) - SEED + 1)
    seeds = first.of(at, at + SEED)
    places = np.lib.stride_tricks.sliding_window_view(seeds, WINDOW - SEED + 1)
    # In parts, as each is copied.
    parts = [places[i : i + CHUNK].argmin(axis=1) for i in range(0, windows, CHUNK)]
    chosen = np.concatenate(parts) + np.arange(windows)
    starts = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    counts = np.diff(np.r_[starts, windows])
    forms = second.of(starts, starts + counts + WINDOW - 1)
    return seeds[chosen[starts]], forms, starts, counts


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(4)]
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            text = text.as_py()
            anchors, forms, starts, counts = anchor_runs(word_hashes(white_words(text)))
            if len(starts):
                columns[0].append(anchors.view(np.int64))
                columns[1].append(forms.view(np.int64))
                columns[2].append(np.full(len(starts), doc_id.as_py(), np.int64))
                columns[3].append(_place(text, starts, counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in columns],
            names=["anchor", "form", "doc_id", "place"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128 bits for every window of the runs listed with a text."""
    for batch in batches:
        columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(4)]
        for doc_id, text, places in zip(
            batch["doc_id"], batch["text"], batch["places"], strict=True
        ):
            text = text.as_py()
            starts, counts = _own_places(text or "", places.as_py())
            if not len(starts):
                continue
            hashes = word_hashes(white_words(text))
            # start, start + 1, ... for each run.
            at = np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts)
            at = np.unique(at + np.arange(len(at)))
            columns[0].append(Rolling(hashes, 3).of(at, at + WINDOW).view(np.int64))
            columns[1].append(Rolling(hashes, 4).of(at, at + WINDOW).view(np.int64))
            columns[2].append(np.full(len(at), doc_id.as_py(), np.int64))
            columns[3].append(_place(text, at, np.ones(len(at), np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in columns],
            names=["high", "low", "doc_id", "place"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    """Documents that can be named.  All joins with texts take this one frame, so
    that their shuffle is planned once and reused."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.where("doc_id is not null")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, places``: the packed windows of each document that also start in
    a document with a smaller id (documents without any are absent)."""
    prepare(docs.sparkSession)
    texts = _texts(docs)
    runs = texts.mapInArrow(_seeds, "anchor long, form long, doc_id long, place long")
    # Stored, so that a hot anchor's runs can be split in the join.
    shared = stored(
        runs.groupBy("anchor")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("anchor")
    )
    met = stored(runs.join(shared, "anchor"))
    forms = stored(met.groupBy("anchor", "form").agg(F.min("doc_id").alias("first")))
    several = forms.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    owners = stored(
        met.join(stored(forms.join(several, "anchor").drop("n")), ["anchor", "form"])
        .where("doc_id = first")
        .groupBy("doc_id")
        .agg(F.collect_set("place").alias("places"))
    )
    # Not stored: computing these twice costs less than keeping them.
    windows = texts.join(owners, "doc_id").mapInArrow(
        _windows, "high long, low long, doc_id long, place long"
    )
    earliest = (
        windows.groupBy("high", "low")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .drop("last")
    )
    extended = windows.join(earliest, ["high", "low"]).where("first < doc_id")
    whole = met.join(forms, ["anchor", "form"]).where("first < doc_id")
    return (
        whole.select("doc_id", "place")
        .union(extended.select("doc_id", "place"))
        .groupBy("doc_id")
        .agg(F.collect_set("place").alias("places"))
    )


def maximal_repeats(text: str | None, places: list[int] | None) -> list[tuple[int, int]]:
    """The maximal word ranges ``[start, end)`` that the repeated windows cover."""
    starts, counts = _own_places(text or "", places)
    spans: list[tuple[int, int]] = []
    for start, count in sorted(zip(starts.tolist(), counts.tolist(), strict=True)):
        end = start + count + WINDOW - 1
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, kept, found = [], [], [], []
        for text, places in zip(batch["text"], batch["places"], strict=True):
            text = text.as_py()
            words = white_words(text)
            spans = maximal_repeats(text, places.as_py()) if places.is_valid else []
            rest, at = [], 0
            for start, end in spans:
                rest += words[at:start]
                at = end
            rest += words[at:]
            sizes.append(len(words))
            removed.append(len(words) - len(rest))
            kept.append(b" ".join(rest).decode())
            found.append([{"start": start, "end": end} for start, end in spans])
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.string()),
                pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_text", "repeats"],
        )


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, repeats`` for every row of
    ``docs`` (``doc_id``, ``text``; other columns do not matter).

    ``repeats`` are the maximal word ranges covered by windows that also start in
    a document with a smaller id; ``kept_text`` has the other words, one space
    between.  Null, empty and short texts have no window.  A row without a
    ``doc_id`` is neither earlier nor later than another, so it stays whole and
    cuts nothing.  Rows that share an id are one document: they do not cut each
    other.  No rows give no rows.
    """
    schema = (
        "doc_id long, n_words long, n_removed long, kept_text string, "
        "repeats array<struct<start: long, end: long>>"
    )
    named = _texts(docs).join(repeated_windows(docs), "doc_id", "left")
    nameless = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(None).cast("array<long>").alias("places"),
    )
    return named.mapInArrow(_cut, schema).union(nameless.mapInArrow(_cut, schema))


def digest(cut: DataFrame) -> DataFrame:
    """``cut_repeats`` with the kept text as its SHA-256."""
    return cut.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
