r"""Source divergence audit: which sources of a language differ, and in what terms.

Tasks tally the terms of the texts they read and hand on rows of fixed width: a
64-bit digest of the term and its counts.  Those are all that counting shuffles.
Of the digests that are kept, the smallest and the largest string show whether
terms share one; these terms, and no others, are counted again by their strings.
Strings are joined back only to the terms that are returned.

A pair of sources is compared over all kept terms of the language, but most of
them occur in neither: a term that does not occur has one smoothed share per
source, so only terms that both have are joined, terms of one of them enter as
the histogram of its shares, and the rest as a number.  All arithmetic is on
integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stored import prepare, stored

LEAST_DOCS = 3
RANKS = 200
SCALE = 1_000_000_000

# Terms held by a task before it hands on what it has counted, and bytes of a
# text that are cut into terms at once.
HELD = 1 << 19
PIECE = 1 << 20

# Groups of language and source that are broadcast; a row has about 100 bytes.
BROADCAST_GROUPS = 100_000

KEY = ["lang", "digest", "split"]
_LETTERS = [*range(0x61, 0x7B), *range(0x80, 0x100)]
# Only A-Z are lower-cased; other characters part terms.
_TABLE = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256)
)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text (UTF-8), in pieces of bounded size."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        # To where no term continues.
        while end < len(text) and _TABLE[text[end]] != 0x20:
            end += 1
        yield text[start:end].translate(_TABLE).split()
        start = end


def digests(terms: list[bytes], bits: int) -> np.ndarray:
    """The upper ``bits`` of 64 for each term."""
    values = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
    return (values >> np.uint64(64 - bits)).view(np.int64)


def _tallies(bits: int, with_terms: bool = False) -> Callable:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By group: occurrences of each term, and documents that have it.
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (uses, docs) in held.items():
                terms = list(uses)
                columns = {
                    "lang": pa.array([lang] * len(terms), pa.string()),
                    "source": pa.array([source] * len(terms), pa.string()),
                    "digest": pa.array(digests(terms, bits)),
                    "n": pa.array(list(uses.values()), pa.int64()),
                    "docs": pa.array([docs[t] for t in terms], pa.int64()),
                }
                if with_terms:
                    columns["split"] = pa.array(terms, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
            held.clear()

        for batch in batches:
            for lang, source, text in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                uses, docs = held.setdefault((lang, source), (Counter(), Counter()))
                own: set[bytes] = set()
                for terms in pieces(text):
                    uses.update(terms)
                    own.update(terms)
                docs.update(own)
            if sum(len(uses) for uses, _ in held.values()) > HELD:
                yield from handed_on()
        yield from handed_on()

    return counted


def _strings(bits: int) -> Callable:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, set[bytes]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                terms = list(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(terms), pa.string()),
                        pa.array(digests(terms, bits)),
                        pa.array(terms, pa.binary()),
                    ],
                    names=["lang", "digest", "term"],
                )
            held.clear()

        for batch in batches:
            for lang, text in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                for terms in pieces(text):
                    held.setdefault(lang, set()).update(terms)
            if sum(map(len, held.values())) > HELD:
                yield from handed_on()
        yield from handed_on()

    return listed


def documents_of(docs: DataFrame) -> DataFrame:
    """``lang, source, text`` with nulls as empty strings; the text as bytes."""
    lang, source, text = (
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")
    )
    return docs.select(lang, source, text.cast("binary").alias("text"))


def tallies(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``lang, source, digest, split, n, docs``: how often, and in how many documents,
    a digest's terms occur in what a task has read of a group."""
    prepare(docs.sparkSession)
    schema = "lang string, source string, digest long, n long, docs long"
    return (
        documents_of(docs)
        .mapInArrow(_tallies(bits), schema)
        .withColumn("split", F.lit(b""))
    )


def strings(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``lang, digest, term``: the terms in what a task has read of a language."""
    prepare(docs.sparkSession)
    texts = documents_of(docs).select("lang", "text")
    return texts.mapInArrow(_strings(bits), "lang string, digest long, term binary")


def occurrences(found: DataFrame, least_docs: int) -> DataFrame:
    """``lang, digest, split, total, uses`` for each kept term: its count in the
    language, and ``source, n`` of the sources that have it.  Tallies are moved
    once, to all of their term."""
    return (
        found.repartition("lang", "digest")
        .groupBy(*KEY, "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy(*KEY)
        .agg(
            F.sum("n").alias("total"),
            F.sum("docs").alias("docs"),
            # At most one entry for each source.
            F.collect_list(F.struct("source", "n")).alias("uses"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )


def dictionary(docs: DataFrame, kept: DataFrame, bits: int = 64) -> DataFrame:
    """``lang, digest, low, high``: the smallest and the largest string of each
    digest in ``kept`` (``lang, digest``)."""
    return (
        strings(docs, bits)
        .repartition("lang", "digest")
        .groupBy("lang", "digest")
        .agg(F.min("term").alias("low"), F.max("term").alias("high"))
        .join(kept, ["lang", "digest"], "left_semi")
    )


def split(docs: DataFrame, shared: DataFrame, least_docs: int, bits: int) -> DataFrame:
    """``occurrences`` of the terms of digests in ``shared`` (``lang, digest``),
    which are counted by their strings."""
    prepare(docs.sparkSession)
    schema = "lang string, source string, digest long, n long, docs long, split binary"
    texts = documents_of(docs)
    found = texts.mapInArrow(_tallies(bits, with_terms=True), schema)
    return occurrences(found.join(shared, ["lang", "digest"]), least_docs)


def smoothed(n: Column | str, total: Column | str, kept: Column | str) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + kept))``; 1 where nothing is kept."""
    n, total, kept = (F.col(c) if isinstance(c, str) else c for c in (n, total, kept))
    of = F.greatest(total + kept, F.lit(1))
    # The product fits 64 bits, or is formed as a decimal.
    long = F.call_function("div", F.lit(SCALE).cast("long") * (n + 1), of)
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    wide = F.call_function("div", wide, of.cast("decimal(20,0)"))
    return 1 + F.when(n < 2**63 // SCALE - 1, long).otherwise(wide)


def distance(p: str, q: str) -> Column:
    """``floor((p - q) ** 2 / q)``"""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _few(rows: DataFrame) -> DataFrame:
    """Stored rows, broadcast if they are counted to be few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_GROUPS else rows


def group_sizes(groups: DataFrame, occur: DataFrame) -> DataFrame:
    """``lang, source, size, terms, kept, lang_size, p0`` of every group: kept
    occurrences and terms, those of its language, the share of an absent term."""
    own = (
        occur.select("lang", F.inline("uses"))
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("terms"))
    )
    lang = occur.groupBy("lang").agg(
        F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("kept")
    )
    return (
        groups.join(own, ["lang", "source"], "left")
        .join(lang, "lang", "left")
        .na.fill(0, ["size", "terms", "kept", "lang_size"])
        .withColumn("p0", smoothed(F.lit(0).cast("long"), "size", "kept"))
    )


def pair_part(occur: DataFrame, shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language."""

    def beyond(a: str, b: str) -> Column:
        """What a term both have adds to a sum over those of one and none."""
        return (
            distance(f"p{a}", f"p{b}")
            - distance(f"p{a}", f"p0{b}")
            - distance(f"p0{a}", f"p{b}")
            + distance(f"p0{a}", f"p0{b}")
        )

    def shared(number: str) -> DataFrame:
        """The sizes of one of two groups."""
        of = {c: f"{c}{number}" for c in ("source", "size", "p0")}
        return _few(sizes.select("lang", "kept", "source", "size", "p0").withColumnsRenamed(of))

    # The sources of a term, against each other.
    both = (
        occur.select("lang", F.inline("uses").alias("source1", "n1"), "uses")
        .select("lang", "source1", "n1", F.inline("uses").alias("source2", "n2"))
        .where("source1 < source2")
        .join(shared("1"), ["lang", "source1"])
        .join(shared("2").drop("kept"), ["lang", "source2"])
        .withColumn("p1", smoothed("n1", "size1", "kept"))
        .withColumn("p2", smoothed("n2", "size2", "kept"))
        .groupBy("lang", "source1", "source2")
        .agg(F.sum(beyond("1", "2")).alias("v12"), F.sum(beyond("2", "1")).alias("v21"))
    )
    histogram = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    others = sizes.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    alone = (
        histogram.join(_few(others), "lang")
        .where("source <> other")
        .groupBy("lang", "source", "other")
        .agg(
            F.sum(F.col("m") * distance("p", "q0")).alias("v12"),
            F.sum(F.col("m") * distance("q0", "p")).alias("v21"),
        )
        .toDF(*both.columns)
    )
    rest = sizes.select(
        "lang", F.col("source").alias("source1"), "kept", F.col("terms").alias("terms1"), "p0"
    ).join(
        _few(sizes.select(
            "lang",
            F.col("source").alias("source2"),
            F.col("terms").alias("terms2"),
            F.col("p0").alias("q0"),
        )),
        "lang",
    ).where("source1 <> source2")
    none = rest.select(
        "lang",
        F.col("source1").alias("source"),
        F.col("source2").alias("item"),
        (F.expr("kept - terms1 - terms2") * distance("p0", "q0")).alias("value"),
    )
    ways = both.unionByName(alone)
    return (
        ways.select("lang", "source1", "source2", "v12")
        .union(ways.select("lang", "source2", "source1", "v21"))
        .toDF("lang", "source", "item", "value")
        .union(none)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def term_part(shares: DataFrame, names: DataFrame, ranks: int) -> DataFrame:
    """``lang, source, item, value``: of each group the ``ranks`` terms whose share
    is furthest above the language's, and those that tie with the last of them."""
    above = shares.where("p > q").select(
        *KEY, "source", distance("p", "q").alias("value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    least = (
        above.select("lang", "source", "value", F.row_number().over(by_value).alias("at"))
        .where(F.col("at") <= ranks)
        .groupBy("lang", "source")
        .agg(F.min("value").alias("least"))
    )
    chosen = above.join(_few(stored(least)), ["lang", "source"]).where("value >= least")
    item = F.when(F.length("split") > 0, F.col("split")).otherwise(F.col("low"))
    return stored(chosen).join(names.drop("high"), ["lang", "digest"]).select(
        "lang", "source", item.cast("string").alias("item"), "value"
    )


def audit(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    ranks: int = RANKS,
    bits: int = 64,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far every two sources of a
    language are apart (``pair``, all ranks), and the terms that a source has more
    of than its language (``term``, the first ``ranks``).

    ``docs`` has ``lang``, ``source`` and ``text``; other columns do not matter.
    Null is an empty string, and so a language or source of its own.  A group
    without terms is compared like others; where a language has no term in
    ``least_docs`` documents, its pairs have the value 0.  Rows that repeat count
    as often as they are there.  Equal values rank by item, as bytes.  No rows give
    no rows.  ``bits`` are those of a digest: fewer split more, and change nothing.
    """
    occur = stored(occurrences(tallies(docs, bits), least_docs))
    names = stored(dictionary(docs, occur.select("lang", "digest"), bits))
    shared = stored(names.where("low <> high").select("lang", "digest"))
    if shared.limit(1).count():
        apart = split(docs, shared, least_docs, bits)
        whole = occur.join(shared, ["lang", "digest"], "left_anti")
        occur = stored(whole.unionByName(apart))
    groups = documents_of(docs).select("lang", "source").distinct()
    sizes = stored(group_sizes(groups, occur))
    shares = (
        occur.select(*KEY, "total", F.inline("uses"))
        .join(_few(sizes), ["lang", "source"])
        .select(
            *KEY,
            "source",
            smoothed("n", "size", "kept").alias("p"),
            smoothed("total", "lang_size", "kept").alias("q"),
        )
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = (
        ("pair", pair_part(occur, shares, sizes), None),
        ("term", term_part(shares, names, ranks), ranks),
    )
    ranked = []
    for part, rows, last in parts:
        rows = rows.withColumn("rank", F.row_number().over(order))
        if last is not None:
            rows = rows.where(F.col("rank") <= last)
        ranked.append(
            rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        )
    return ranked[0].unionByName(ranked[1])
