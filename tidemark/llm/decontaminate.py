"""Benchmark decontamination with a distributed positional inverted index.

A posting list holds the places of a term in a document.  A benchmark window of
consecutive words is looked up from its rarest terms on: the lists of the two
rarest are stored for all documents, the second is adjusted by the offset
between them and intersected with the first.  Windows with the same two terms at
the same offset, as neighbours in an item mostly are, share that intersection.
Only in documents where it leaves a place are the lists of the other terms
formed, and intersected the same way, the rarest first.  Places that survive with
every term at its offset are exact matches of the phrase; those that survive
with every term at most ``SLACK`` words from there are proximity matches, which
tell of windows with a word put in, left out or moved.

All of it is DataFrame functions.  Terms, pairs and windows are broadcast in
blocks of about ``BROADCAST_BYTES``, one pass for each, so a benchmark of any
size is looked up whole.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import stored

WINDOW = 10
SLACK = 2
BROADCAST_BYTES = 64 << 20

# What separates words, once A-Z are in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    other = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).otherwise(other)


def index_words(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    words = F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")
    return F.coalesce(words, F.array().cast("array<string>"))


def positional_index(docs: DataFrame) -> DataFrame:
    """``term, doc_id, positions``: where each term stands in each document."""
    return (
        docs.select("doc_id", F.posexplode(index_words(F.col("text"))).alias("pos", "term"))
        .groupBy("term", "doc_id")
        .agg(F.sort_array(F.collect_list("pos")).alias("positions"))
    )


def _rarest_first(index: DataFrame, terms: list[str]) -> list[str]:
    lists = index.where(F.col("term").isin(terms))
    sizes = dict(lists.groupBy("term").agg(F.sum(F.size("positions"))).collect())
    return sorted(set(terms), key=lambda term: (sizes.get(term, 0), term))


def phrase_matches(index: DataFrame, phrase: list[str]) -> DataFrame:
    """``doc_id, start`` of every occurrence of a phrase: offset-adjusted lists
    are intersected from the rarest term on."""
    found: DataFrame | None = None
    for term in _rarest_first(index, phrase):
        own = index.where(F.col("term") == term)
        for offset in (i for i, word in enumerate(phrase) if word == term):
            starts = own.select(
                "doc_id", F.expr(f"transform(positions, p -> p - {offset})").alias("here")
            )
            if found is None:
                found = starts.withColumnRenamed("here", "starts")
            else:
                found = found.join(starts, "doc_id").select(
                    "doc_id", F.array_intersect("starts", "here").alias("starts")
                )
    return found.select("doc_id", F.explode("starts").alias("start")).where("start >= 0")


def proximity_matches(index: DataFrame, terms: list[str], within: int) -> DataFrame:
    """``doc_id, at``: places of the rarest term that have every other term at
    most ``within`` words away."""
    rarest, *others = _rarest_first(index, terms)
    found = index.where(F.col("term") == rarest).select(
        "doc_id", F.col("positions").alias("places")
    )
    for term in others:
        near = index.where(F.col("term") == term).select("doc_id", "positions")
        found = found.join(near, "doc_id").select(
            "doc_id",
            F.expr(
                "filter(places, p -> exists(positions, q -> "
                f"q between p - {int(within)} and p + {int(within)}))"
            ).alias("places"),
        )
    return found.select("doc_id", F.explode("places").alias("at"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, phrase, size``: the windows of ``WINDOW`` words of each item, or
    the whole of a shorter one, as words joined by a space."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"),
        index_words(F.col("text").cast("string")).alias("words"),
    ).where(F.size("words") > 0)
    sized = words.withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    return (
        sized.select("*", starts.alias("start"))
        .select(
            "item_id",
            F.array_join(F.expr("slice(words, start, size)"), " ").alias("phrase"),
            "size",
        )
        .distinct()
    )


def _in_blocks(
    table: DataFrame, size: Column, limit: int, look: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``look`` at a table keyed by ``term``, broadcast in blocks of about
    ``limit`` bytes."""
    total = table.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // limit))
    parts = [
        look(F.broadcast(table.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i)))
        for i in range(blocks)
    ]
    return reduce(DataFrame.union, parts)


def _posting_lists(words: DataFrame, terms: DataFrame, limit: int) -> DataFrame:
    """``doc, term, positions``: the lists of some terms (``term``) over ``doc, words``."""

    def look(block: DataFrame) -> DataFrame:
        placed = words.select("doc", F.posexplode("words").alias("pos", "term"))
        # A set, as a row may be repeated.
        return (
            placed.join(block, "term", "left_semi")
            .groupBy("doc", "term")
            .agg(F.sort_array(F.collect_set("pos")).alias("positions"))
        )

    return _in_blocks(terms, F.octet_length("term") + 16, limit, look)


def _documents(docs: DataFrame) -> DataFrame:
    """``doc, text``; a row is named by its id and its text, so that ids may repeat
    or be null."""
    doc = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_id"))
    return docs.select(doc.alias("doc"), "text")


def _words(documents: DataFrame) -> DataFrame:
    return documents.select("doc", index_words(F.col("text")).alias("words"))


def window_plans(documents: DataFrame, phrases: DataFrame, limit: int) -> DataFrame:
    """``phrase_id, size, plan`` for the phrases (``phrase``, ``size``) whose words all
    occur in ``documents``: ``plan`` has ``n, term, offset`` of each word, the rarest
    first."""
    terms = phrases.select(
        "phrase", "size", F.posexplode(F.split("phrase", " ")).alias("offset", "term")
    )
    vocabulary = stored(terms.select("term").distinct())
    frequency = _in_blocks(
        vocabulary,
        F.octet_length("term") + 16,
        limit,
        lambda block: _words(documents)
        .select(F.explode("words").alias("term"))
        .join(block, "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n")),
    )
    # A window with a term that no document has does not occur.
    return (
        terms.join(stored(frequency), "term", "left")
        .groupBy("phrase", "size")
        .agg(
            F.sort_array(F.collect_list(F.struct("n", "term", "offset"))).alias("plan"),
            F.min(F.col("n").isNotNull()).alias("possible"),
        )
        .where("possible")
        .select(F.xxhash64("phrase").alias("phrase_id"), "size", "plan")
    )


def _beside(positions: str, shift: str) -> str:
    """SQL for a list moved by ``shift``, with all places up to ``SLACK`` around."""
    return (
        f"flatten(transform(sequence(-{SLACK}, {SLACK}), "
        f"slack -> transform({positions}, q -> q - ({shift}) + slack)))"
    )


def pair_places(lists: DataFrame, plans: DataFrame, limit: int) -> DataFrame:
    """``doc, term, second, delta, places``: where in a document the rarest term of
    a window has the second rarest about ``delta`` words on; once for all windows
    that share the two."""
    pairs = plans.where("size > 1").select(
        F.expr("plan[0].term").alias("term"),
        F.expr("plan[1].term").alias("second"),
        F.expr("plan[1].offset - plan[0].offset").alias("delta"),
    )
    size = F.octet_length("term") + F.octet_length("second") + 32
    first = _in_blocks(
        stored(pairs.distinct()), size, limit, lambda block: lists.join(block, "term")
    )
    other = lists.select("doc", F.col("term").alias("second"), F.col("positions").alias("others"))
    places = F.expr(f"array_intersect(positions, {_beside('others', 'delta')})")
    return (
        first.join(other, ["doc", "second"])
        .select("doc", "term", "second", "delta", places.alias("places"))
        .where("size(places) > 0")
    )


def candidates(lists: DataFrame, plans: DataFrame, limit: int) -> DataFrame:
    """``doc, phrase_id, size, plan, starts``: where windows would start by their two
    rarest terms."""
    places = stored(pair_places(lists, plans, limit))
    leads = plans.where("size > 1").select(
        "*",
        F.expr("plan[0].term").alias("term"),
        F.expr("plan[1].term").alias("second"),
        F.expr("plan[1].offset - plan[0].offset").alias("delta"),
    )
    words = F.expr("aggregate(plan, 0, (b, t) -> b + octet_length(t.term) + 32)")
    return _in_blocks(
        leads, words + 64, limit, lambda block: places.join(block, ["term", "second", "delta"])
    ).select(
        "doc",
        "phrase_id",
        "size",
        "plan",
        F.expr("transform(places, p -> p - plan[0].offset)").alias("starts"),
    )


def window_matches(docs: DataFrame, phrases: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``doc, phrase_id, size, starts, near`` for every document and phrase
    (``phrase``, ``size``) with a match: ``starts`` of the exact ones, and ``near``
    of all that hold by proximity.

    A phrase matches by proximity at a place of its rarest word (of equals the first
    by UTF-8, then by offset) if each other word stands at most ``SLACK`` words from
    where the phrase has it."""
    documents = _documents(docs)
    plans = stored(window_plans(documents, phrases, limit))
    leads = plans.select(F.explode(F.slice("plan", 1, 2)).alias("lead"))
    lists = stored(
        _posting_lists(_words(documents), stored(leads.select("lead.term").distinct()), limit)
    )
    found = stored(candidates(lists, plans, limit))
    # The lists of the other terms, in documents with a candidate.
    alive = stored(found.select("doc").distinct())
    few = alive.count() * 64 <= limit
    texts = documents.join(F.broadcast(alive) if few else alive, "doc", "left_semi")
    rest = stored(found.select(F.explode("plan.term").alias("term")).distinct())
    index = (
        _posting_lists(_words(texts), rest, limit)
        .groupBy("doc")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("lists"))
    )
    listed = "coalesce(lists[t.term], array())"
    exact = f"transform({listed}, q -> q - t.offset)"
    near = _beside(listed, "t.offset")
    tried = (
        found.groupBy("doc")
        .agg(F.collect_list(F.struct("phrase_id", "size", "plan", "starts")).alias("windows"))
        .join(index, "doc")
        .withColumn(
            "windows",
            F.expr(
                "filter(transform(windows, w -> struct(w.phrase_id, w.size, w.plan, "
                "aggregate(slice(w.plan, 2, w.size), w.starts, "
                f"(s, t) -> array_intersect(s, {near})) as near)), "
                "w -> size(w.near) > 0)"
            ),
        )
        .select(
            "doc",
            F.expr(
                "inline(transform(windows, w -> struct(w.phrase_id, w.size, "
                "aggregate(slice(w.plan, 2, w.size), w.near, "
                f"(s, t) -> array_intersect(s, {exact})) as starts, w.near)))"
            ),
        )
    )
    # A phrase of one word is its list.
    single = plans.where("size = 1").select(
        F.expr("plan[0].term").alias("term"), "phrase_id", "size"
    )
    alone = _in_blocks(
        single, F.octet_length("term") + 32, limit, lambda block: lists.join(block, "term")
    ).select(
        "doc", "phrase_id", "size", F.col("positions").alias("starts"), F.col("positions").alias("near")
    )
    return tried.union(alone)


def contamination(
    docs: DataFrame, benchmark: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``doc_id, text_id, n_words, n_hit, items, near_items, contaminated`` for every
    row of ``docs`` (``doc_id``, ``text``) against ``benchmark`` (``item_id``, ``text``);
    other columns do not matter.

    A word is hit if it stands inside an occurrence of an item's window; ``items``
    are the ids, as sorted strings, of the items with such windows, and
    ``near_items`` of those with a window that matches by proximity (or exactly).
    Proximity contaminates nothing.  Null and empty texts have no words, on either
    side.  An item without an id marks words but is not listed.  Repeated rows and
    ids are judged row by row.  No items: no hits; no documents: no rows.
    """
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    windows = stored(item_windows(benchmark))
    phrases = windows.select("phrase", "size").distinct()
    matches = stored(window_matches(docs, phrases, limit))
    places = matches.groupBy("doc").agg(
        F.size(
            F.array_distinct(
                F.flatten(
                    F.flatten(
                        F.collect_list(
                            F.expr("transform(starts, s -> sequence(s, s + size - 1))")
                        )
                    )
                )
            )
        )
        .cast("long")
        .alias("n_hit")
    )
    owners = windows.select(F.xxhash64("phrase").alias("phrase_id"), "item_id")
    exact = F.when(F.col("exact"), F.col("item_id"))
    items = (
        matches.select("doc", "phrase_id", (F.size("starts") > 0).alias("exact"))
        .join(owners, "phrase_id")
        .groupBy("doc")
        .agg(
            F.sort_array(F.collect_set(exact)).alias("items"),
            F.sort_array(F.collect_set("item_id")).alias("near_items"),
        )
    )
    own = _documents(docs).select(
        "doc", F.size(index_words(F.col("text"))).cast("long").alias("n_words")
    )
    nothing = F.array().cast("array<string>")
    return own.join(places.join(items, "doc"), "doc", "left").select(
        "doc.doc_id",
        "doc.text_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", nothing).alias("items"),
        F.coalesce("near_items", nothing).alias("near_items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def digest(found: DataFrame) -> DataFrame:
    """``contamination`` with the items as numbers and a SHA-256."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no window occurs in."""
    found = contamination(docs, benchmark, limit).where("contaminated")
    found = found.select(F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text")).distinct()
    own_text = F.xxhash64(docs["text"].cast("string"))
    return docs.join(
        found, docs["doc_id"].eqNullSafe(found["_doc"]) & (own_text == found["_text"]), "left_anti"
    )
