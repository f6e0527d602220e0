"""MinHash near-dedup by min-max hashing.

Every permutation of a document's shingles gives two signature values, its
smallest and its largest hash, so ``PERMUTATIONS`` hash evaluations a shingle
make twice as many values, each an unbiased estimate of the Jaccard similarity
(and the pair of a lower variance than two minima).  The values are banded;
documents that agree on a whole band are candidates, and every candidate link
is confirmed on the full shingle sets.

Nothing is compared for all pairs of a group.  Documents with equal sets become
one representative.  Each band bucket first links its members to its smallest
one only, if their sketches allow the similarity:

- a bitmap in which each shingle flips one bit.  Two bitmaps differ in no more
  bits than the sets differ in shingles, so this test loses nothing;
- one bit of each signature value, for sets that fill the bitmap.

Components of those links are formed.  Of buckets that still hold several, members
meet by prefix filtering: similar sets share a shingle among the rarest of each (all
but the similarity's share of a set, plus one), so only members that share such a
rare shingle are compared.  Pages of one template that differ by a fifth share their
common shingles only, and never meet.

Bands follow from the similarity: as wide as a pair at the threshold misses all of
them with probability 1e-6 at most (9e-7 at 0.85), and the second test with 4e-6 (4.5
standard deviations); both fall fast above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.stored import prepare, stored
from tidemark.llm.words import window_hashes, word_hashes

SHINGLE = 5
SIMILAR_PERCENT = 85

PERMUTATIONS = 128
MISSED = 1e-6
# Slots that shingles are counted in, to tell rare ones from common ones.
SLOT_BITS = 18
SKETCH_LONGS = 2 * PERMUTATIONS // 64
FLIP_LONGS = 16

# Shingles hashed at once, which bounds a task's memory for very long texts.
CHUNK = 4096


def band_rows(percent: int) -> int:
    """The most values of a band with which a pair of this similarity misses all bands
    with a probability of at most ``MISSED``."""
    values, share = 2 * PERMUTATIONS, percent / 100
    return max(
        [r for r in range(1, values + 1) if (1 - share**r) ** (values // r) <= MISSED], default=1
    )


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles, hashed and sorted; a shorter text is one shingle.
    On bytes, ``lower`` changes A-Z only."""
    words = text.encode().lower().split() if text else []
    hashes = word_hashes(words)
    if not words:
        return hashes
    return np.unique(window_hashes(hashes, min(SHINGLE, len(words))))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd factors and offsets of the permutations of 32-bit hashes."""
    draw = np.random.Generator(np.random.PCG64(20240229))
    factors = draw.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
    return factors[:, None], draw.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The minimum and the maximum under each permutation, side by side."""
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), CHUNK):
        values = short[None, start : start + CHUNK] * factors
        values += offsets
        # The high bits of a product order the hashes; rotate in the low ones.
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high], axis=1).reshape(-1)


def flipped_bits(shingles: np.ndarray) -> np.ndarray:
    """The bitmap in which every shingle flips the bit its hash names."""
    bits = np.bincount((shingles % np.uint64(64 * FLIP_LONGS)).astype(np.int64)) & 1
    bits = np.pad(bits, (0, 64 * FLIP_LONGS - len(bits))).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _sign(rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, offsets = _factors()
    n_bands = 2 * PERMUTATIONS // rows
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for batch in batches:
        sizes, sets, bands, sketches, flips = [], [], [], [], []
        for text in batch["text"]:
            shingles = shingle_set(text.as_py())
            sizes.append(len(shingles))
            sets.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            if not len(shingles):
                bands.append([])
                sketches.append([])
                flips.append([])
                continue
            values = signature(shingles, factors, offsets)
            keyed = values[: n_bands * rows].reshape(n_bands, rows)
            bands.append(
                [
                    # Signed, and different for each band.
                    xxhash.xxh3_64_intdigest(row.tobytes(), i) - 2**63
                    for i, row in enumerate(keyed)
                ]
            )
            # A bit that does not depend on the order of the values.
            bit = (values * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint64)
            sketches.append((bit.reshape(-1, 64) * weights).sum(axis=1).view(np.int64).tolist())
            flips.append(flipped_bits(shingles).tolist())
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(sets, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(sketches, pa.list_(pa.int64())),
                pa.array(flips, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "set_id", "bands", "sketch", "flips"],
        )


def signatures(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, set_id, bands, sketch, flips`` for each document."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        partial(_sign, band_rows(percent)),
        "doc_id long, n_shingles long, set_id binary, bands array<long>, "
        "sketch array<long>, flips array<long>",
    )


def differing_bits_allowed(percent: int) -> int:
    """Bits of a sketch that may differ between similar sets."""
    bits = 64 * SKETCH_LONGS
    share = (1 - percent / 100) / 2
    return int(np.ceil(bits * share + 4.5 * np.sqrt(bits * share * (1 - share))))


def _differing(column: str, longs: int) -> Column:
    """Bits in which the columns of the two sides, ``_a`` and ``_b``, differ."""
    bits = [
        F.bit_count(F.col(f"{column}_a")[i].bitwiseXOR(F.col(f"{column}_b")[i])).cast("int")
        for i in range(longs)
    ]
    return reduce(Column.__add__, bits)


def _sketches_allow(percent: int) -> Column:
    both = F.col("n_shingles_a") + F.col("n_shingles_b")
    return (
        (100 + percent) * _differing("flips", FLIP_LONGS) <= (100 - percent) * both
    ) & (_differing("sketch", SKETCH_LONGS) <= differing_bits_allowed(percent))


def _confirm(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
    for batch in batches:
        keep = []
        for text_a, text_b in zip(batch["text_a"], batch["text_b"], strict=True):
            # Rows come sorted by the first document.
            if text_a.as_py() != known[0]:
                known = (text_a.as_py(), shingle_set(text_a.as_py()))
            left, right = known[1], shingle_set(text_b.as_py())
            total = len(left) + len(right)
            both = total - len(np.unique(np.concatenate([left, right])))
            keep.append(100 * both >= percent * (total - both))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_())
        )


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough."""
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return stored(full.mapInArrow(partial(_confirm, percent), "a long, b long"))


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        for text in batch["text"].to_pylist():
            np.add.at(counts, _slots(shingle_set(text)), 1)
    hit = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["slot", "n"])


def _prefixes(
    percent: int, counts: np.ndarray, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            doc_id, shingles = doc_id.as_py(), shingle_set(text.as_py())
            # All that similar sets may differ in, and one more.
            size = len(shingles) - -(-percent * len(shingles) // 100) + 1
            rarest = np.lexsort((shingles, counts[_slots(shingles)]))[:size]
            found.append(shingles[rarest])
            ids.append(np.full(len(rarest), doc_id, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(ids)), pa.array(np.concatenate(found).view(np.int64))],
            names=["doc_id", "shingle"],
        )


def rare_shingles(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``doc_id, shingle``: of each member (``doc_id``) the rarest shingles, of which two
    similar sets share one.  That holds for any order all sets are sorted by; the
    counts it follows here are those of ``1 << SLOT_BITS`` slots, at most so many
    rows, and where shingles share a slot, more members meet but no link is lost."""
    own = texts.join(members.select("doc_id").distinct(), "doc_id").select("doc_id", "text")
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    tallies = own.mapInArrow(_tally, "slot long, n long").groupBy("slot").agg(F.sum("n"))
    for slot, n in tallies.collect():
        counts[slot] = n
    # Rows of one id may repeat.
    schema = "doc_id long, shingle long"
    return own.mapInArrow(partial(_prefixes, percent, counts), schema).distinct()


def open_members(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """``doc_id, component`` of members of buckets that hold several components.
    Heads have met everyone in their buckets."""
    labelled = shared.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "band", "doc_id", "head", F.coalesce("component", "doc_id").alias("component")
    )
    several = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("band")
    )
    return labelled.where("doc_id <> head").join(several, "band").select(
        "doc_id", "component"
    ).distinct()


def compared_pairs(members: DataFrame, rare: DataFrame) -> DataFrame:
    """Members of different components that share a rare shingle, side by side."""
    full = rare.join(members, "doc_id")
    left = full.select("shingle", *[F.col(c).alias(f"{c}_a") for c in members.columns])
    right = full.select("shingle", *[F.col(c).alias(f"{c}_b") for c in members.columns])
    return left.join(right, "shingle").where(
        "doc_id_a < doc_id_b and component_a <> component_b"
    )


def _missed_links(
    shared: DataFrame, reps: DataFrame, groups: DataFrame, texts: DataFrame, percent: int
) -> DataFrame:
    """Links that the stars have not shown."""
    members = stored(
        open_members(shared, groups).join(
            reps.select("doc_id", "n_shingles", "sketch", "flips"), "doc_id"
        )
    )
    rare = stored(rare_shingles(members, texts, percent))
    pairs = compared_pairs(members, rare).where(_sketches_allow(percent))
    return _confirmed(
        pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct(),
        texts,
        percent,
    )


def near_duplicates(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``
    (``doc_id``, ``text``; other columns do not matter).  ``percent`` is the least
    similarity of a link.

    Null, empty and blank texts have no shingles and link with nothing.  Rows
    that share a ``doc_id`` are one document: they get one component, and links
    of any of their texts count.  A row without a ``doc_id`` cannot be named by
    others: its component is null and it is kept.  No rows give no rows.
    """
    signed = stored(signatures(docs, percent))
    named = signed.where("n_shingles > 0 and doc_id is not null")
    # One representative for each set; copies are never paired.  What follows is
    # stored where rows of one key meet again, so that a hot key can be split.
    classes = stored(named.groupBy("set_id").agg(F.min("doc_id").alias("rep")))
    reps = stored(
        named.join(classes, "set_id")
        .where("doc_id = rep")
        .dropDuplicates(["doc_id", "set_id"])
        .select("doc_id", "n_shingles", "bands", "sketch", "flips")
    )
    members = reps.select("doc_id", F.explode("bands").alias("band"))
    heads = stored(
        members.groupBy("band")
        .agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"))
        .where("head < last")
    )
    # Members of buckets that hold more than one document.
    shared = stored(members.join(heads, "band").select("band", "doc_id", "head"))
    texts = stored(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
            shared.select("doc_id").distinct(), "doc_id"
        )
    )
    sketches = reps.drop("bands")
    stars = (
        shared.where("head < doc_id")
        .select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
        .join(sketches.toDF(*[f"{c}_a" for c in sketches.columns]), F.expr("a = doc_id_a"))
        .join(sketches.toDF(*[f"{c}_b" for c in sketches.columns]), F.expr("b = doc_id_b"))
        .where(_sketches_allow(percent))
        .select("a", "b")
    )
    links = _confirmed(stars, texts, percent)
    links = links.union(_missed_links(shared, reps, components(links), texts, percent))
    # An id with several texts joins their classes.
    several = (
        named.groupBy("doc_id")
        .agg(F.min("set_id").alias("first"), F.max("set_id").alias("last"))
        .where("first <> last")
        .select("doc_id")
    )
    links = links.union(
        named.join(several, "doc_id")
        .join(classes, "set_id")
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )
    found = classes.join(
        components(links).withColumnRenamed("node", "rep"), "rep", "left"
    ).select("set_id", F.coalesce("component", "rep").alias("component"))
    return (
        signed.join(found, "set_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.col("component"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def first_of_each_group(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, without the near copies of a
    document with a smaller id."""
    copies = near_duplicates(docs, percent).where("not kept").select(F.col("doc_id").alias("_doc"))
    copies = copies.distinct()
    return docs.join(copies, docs["doc_id"].cast("long") == copies["_doc"], "left_anti")
