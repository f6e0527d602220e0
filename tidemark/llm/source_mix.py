r"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens raised to an exponent, normalised.
At 1 the mix is the corpus as it is, at 0 all sources weigh the same; between,
the exponent is bisected (``STEPS`` sections a job) to the most even mix whose
smallest source is not repeated more than ``max_repetition`` times, or to a
target entropy.  The budget is the least that takes every document once.

Weights become rows by budgeted block permutations.  In every epoch a source's
documents are dealt into ``BLOCKS`` blocks, the blocks are permuted, then the
documents of each; a source runs whole epochs and the part of a last one that
fits its budget.  Where a copy stands in its source's stream, as a share of the
budget, is its position in the mix: any stretch of positions has the weights.

A prefix sum over blocks and one inside each block replace a sum over a whole
source, so no task sees one.  All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stored import stored

WHITE = r"[\x20\x09-\x0D]+"
MAX_REPETITION = 2.0
SEED = 17
STEPS = 32
ROUNDS = 7
# Exponents and weights are rounded, so that they print and repeat.
EXPONENT_DIGITS = 4
# Three hexadecimal digits number the blocks.
BLOCKS = 16**3


def tokens(text: Column) -> Column:
    """Words of a text, and at least one for each document."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")
    return F.greatest(F.size(words), F.lit(1)).cast("long")


def _draw(*parts: Column | str | int) -> Column:
    """A fixed draw for some values, as 32 hexadecimal digits."""
    given = [part if isinstance(part, Column) else F.lit(str(part)) for part in parts]
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in given]))


def documents_of(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, source, n_tokens``: rows that repeat are one document."""
    text = F.col("text").cast("string")
    return (
        docs.select(
            "doc_id",
            F.coalesce(F.md5(text), F.lit("")).alias("text_id"),
            F.col("source").cast("string").alias("source"),
            tokens(text).alias("n_tokens"),
        )
        .groupBy("doc_id", "text_id", "source")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def _evenness(shares: DataFrame, low: float, high: float) -> list[tuple[float, float, float]]:
    """``exponent, repetition, entropy`` at evenly spaced exponents, in one job."""
    grid = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
    power = F.pow("share", F.col("a"))
    rows = (
        shares.select("share", F.explode(F.array(*map(F.lit, grid))).alias("a"))
        .groupBy("a")
        .agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("l"),
            F.max(F.pow("share", 1 - F.col("a"))).alias("most"),
            F.max(F.pow("share", F.col("a") - 1)).alias("least"),
        )
        .select(
            "a",
            (F.col("most") * F.col("least")).alias("repetition"),
            (F.log("z") - F.col("a") * F.col("l") / F.col("z")).alias("entropy"),
        )
    )
    return sorted(map(tuple, rows.collect()))


def exponent(
    sources: DataFrame,
    max_repetition: float | None = MAX_REPETITION,
    target_entropy: float | None = None,
) -> float:
    """The smallest exponent in [0, 1] that keeps the limit, or the largest with
    at least the target entropy; rounded towards the corpus as it is."""
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    shares = stored(sources.select((F.col("tokens") / F.lit(total)).alias("share")))

    def even_enough(repetition: float, entropy: float) -> bool:
        if target_entropy is not None:
            return entropy <= target_entropy + 1e-12
        return repetition <= max_repetition * (1 + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = _evenness(shares, low, high)
        first = next((i for i, (_, r, h) in enumerate(tried) if even_enough(r, h)), STEPS)
        high = tried[first][0]
        if first == 0 or high - low < 10 ** -(EXPONENT_DIGITS + 4):
            break
        low = tried[first - 1][0]
    scale = 10**EXPONENT_DIGITS
    return min(1.0, -(-round(high * scale, 3) // 1) / scale)


def weights(sources: DataFrame, alpha: float) -> DataFrame:
    """``source, tokens, weight, budget``; the budget of the whole mix is the
    least that takes every document once."""
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(alpha))
    z, scale = sources.agg(F.sum(power), F.max(F.col("tokens") / power)).first()
    return sources.select(
        "source",
        "tokens",
        F.round(power / F.lit(z or 1.0), 9).alias("weight"),
        F.greatest("tokens", F.round(power * F.lit(scale or 0.0)).cast("long")).alias("budget"),
    )


def mix(
    docs: DataFrame,
    max_repetition: float | None = MAX_REPETITION,
    target_entropy: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, text_id, source, n_tokens, weight, epoch, position``: a row for
    each copy of a document (``doc_id``, ``text``, ``source``; other columns do not
    matter) in the mix.

    Every document is there at least once (epoch 0).  Repeated rows are one
    document; null and empty texts weigh one token; a null source is a source.
    One source, or sources alike, need no repetition.  No rows give no rows.
    """
    documents = stored(documents_of(docs))
    sources = stored(documents.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    plan = weights(sources, exponent(sources, max_repetition, target_entropy))
    plan = stored(plan).withColumnRenamed("source", "name")
    copies = (
        documents.join(plan, F.col("source").eqNullSafe(F.col("name")))
        .select(
            "*",
            F.explode(
                F.sequence(F.lit(0), F.ceil(F.col("budget") / F.col("tokens")).cast("int") - 1)
            ).alias("epoch"),
        )
        .select(
            "*",
            F.substring(_draw(seed, F.col("doc_id"), F.col("text_id")), 1, 3).alias("block"),
            _draw(seed, F.col("epoch"), F.col("doc_id"), F.col("text_id")).alias("draw"),
        )
        .withColumn("turn", _draw(seed, F.col("epoch"), F.col("block")))
    )
    # Tokens before a block: at most BLOCKS rows of a source and epoch.
    sizes = copies.groupBy("source", "epoch", "block", "turn").agg(F.sum("n_tokens").alias("size"))
    before = Window.partitionBy("source", "epoch").orderBy("turn", "block")
    offsets = sizes.select(
        F.col("source").alias("of"),
        F.col("epoch").alias("in_epoch"),
        F.col("block").alias("at_block"),
        (F.sum("size").over(before) - F.col("size")).alias("offset"),
    )
    inside = Window.partitionBy("source", "epoch", "block").orderBy("draw", "doc_id", "text_id")
    ended = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = copies.withColumn("ended", ended).join(
        offsets, F.expr("source <=> of and epoch = in_epoch and block = at_block")
    )
    last = F.col("epoch") * F.col("tokens") + F.col("offset") + F.col("ended")
    return placed.where(last <= F.col("budget")).select(
        "doc_id",
        "text_id",
        "source",
        "n_tokens",
        "weight",
        "epoch",
        F.round((last - F.col("n_tokens")) / F.col("budget"), 9).alias("position"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, once for each of their copies
    in the mix."""
    copies = mix(docs, **options).select(
        F.col("doc_id").alias("_doc"),
        F.col("text_id").alias("_text"),
        F.col("source").alias("_from"),
    )
    text_id = F.coalesce(F.md5(docs["text"].cast("string")), F.lit(""))
    return docs.join(
        copies,
        docs["doc_id"].eqNullSafe(copies["_doc"])
        & (text_id == copies["_text"])
        & docs["source"].cast("string").eqNullSafe(copies["_from"]),
    ).select(*[docs[c] for c in docs.columns])
