"""Sharding by balanced label propagation.

Documents with equal texts are linked: they should lie in one shard, so that a
reader of a shard can drop its copies.  Linked documents start spread over all
shards.  A text too large for a shard first fills whole shards; its remainder is a
text like others.  In each round a text wishes to be where most of its documents
are, of equals in one drawn by hash; a whole text in a shard beyond its quota may,
by the excess, wish for a shard with room.  A shard grants the share of the wishes
for it that its quota and a slack leave room for, counting what is about to leave
it; whole texts are granted, by hash, and the slack halves with every round.
Rounds go on until fewer documents than there are shards wish to move, or two
rounds in a row bring no fewer wishes than ever before.  Texts that then still lie
in several shards, or beyond a shard's quota, are laid side by side into what is
left of the quotas, so that only a text at the end of a shard is cut; documents
without a link have no wishes and come last.  In the end the law ``rows`` holds:
counts of any two shards differ by one at most.

Each round is a join of documents with the wish of their text, and its labels
are stored.  What reaches the driver, and goes back as a small table, is a few
numbers for each shard.  Ranks are prefix sums over buckets and inside each of
them, so that no task sorts a shard, and a text with many copies is ranked in
pieces.  All of it is DataFrame functions.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.stored import stored

SHARDS = 40
OVERHEAD = 16
# Buckets of a ranking, at least; for many rows as many as each then holds.
BUCKETS = 4096
LAW = "rows"

_STEPS = 1 << 20
# Copies of one text that are ranked in one piece, at least.
_PIECE = 64


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, text_id`` for every row."""
    text = F.col("text").cast("string")
    raw = F.encode(text, "UTF-8")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.encode(F.lit(""), "UTF-8"))).alias("text_crc32"),
        # Null texts equal nothing.
        F.unhex(F.md5(raw)).alias("text_id"),
    )


def _ranked(rows: DataFrame, by: list[str], keys: dict[str, Column]) -> DataFrame:
    """``rows`` with ``rank``, gapless from 0 within each value of ``by``, in the
    order of ``keys``, then of texts."""
    dealt = rows.withColumns({"draw": F.xxhash64("doc_id", "text_id")}).withColumns(keys)
    counts = dealt.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n"))
    # A row for each bucket and value.
    before = Window.partitionBy(*by).orderBy(*keys)
    offsets = counts.select(*by, *keys, (F.sum("n").over(before) - F.col("n")).alias("before"))
    inside = Window.partitionBy(*by, *keys).orderBy("text_id", "draw", "doc_id")
    return (
        dealt.withColumn("place", F.row_number().over(inside) - 1)
        .join(offsets, [*by, *keys])
        .withColumn("rank", F.col("before") + F.col("place"))
        .drop("draw", *keys, "place", "before")
    )


def _buckets(total: int) -> int:
    return max(BUCKETS, isqrt(total))


def _spread(rows: DataFrame, by: list[str], total: int) -> DataFrame:
    """Ranked in the order of hashes."""
    return _ranked(rows, by, {"bucket": F.pmod("draw", F.lit(_buckets(total)))})


def _side_by_side(rows: DataFrame, by: list[str], total: int) -> DataFrame:
    """Ranked so that rows of one text (of ``copies`` rows) are neighbours.  A text
    with more than its share of ``total`` is dealt to pieces, so there are at most
    3 * _buckets keys."""
    piece = max(_PIECE, -(-total // _buckets(total)))
    many = F.col("copies") > piece
    pieces = F.ceil(F.col("copies") / piece).cast("long")
    keys = {
        "bucket": F.pmod(F.xxhash64("text_id"), F.lit(_buckets(total))),
        "hot": F.when(many, F.col("text_id")).otherwise(F.unhex(F.lit(""))),
        "piece": F.when(many, F.pmod("draw", pieces)).otherwise(F.lit(0).cast("long")),
    }
    return _ranked(rows, by, keys)


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard under the law."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def granted(
    wanted: list[int], leaving: list[int], load: list[int], cap: list[float]
) -> list[float]:
    """The share of the wishes for each shard that is granted: what ``cap`` leaves
    room for, and as much as leaves when wishes are granted at their mean share."""
    total, mean, share = sum(wanted), 1.0, [1.0] * len(load)
    for _ in range(100):
        room = [c - n + out * mean for c, n, out in zip(cap, load, leaving, strict=True)]
        share = [min(1.0, max(0.0, r) / w) if w else 1.0 for r, w in zip(room, wanted, strict=True)]
        before, mean = mean, sum(s * w for s, w in zip(share, wanted, strict=True)) / max(1, total)
        if before - mean < 1e-4:
            break
    return share


def _table(spark: SparkSession, **columns: list[int]) -> DataFrame:
    """A broadcast table of a few numbers for each shard."""
    listed = [
        F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>").alias(name)
        for name, values in columns.items()
    ]
    return F.broadcast(spark.range(1).select(F.inline(F.arrays_zip(*listed))))


def _draw(turn: int, what: str, steps: int = _STEPS) -> Column:
    return F.pmod(F.xxhash64("text_id", F.lit(turn), F.lit(what)), F.lit(steps))


def _round(linked: DataFrame, turn: int, quota: list[int]) -> tuple[DataFrame, int]:
    """One step of label propagation over ``doc_id, text_id, shard``; how many
    documents wished to move."""
    spark, shards = linked.sparkSession, len(quota)
    load = [0] * shards
    for shard, n in linked.groupBy("shard").count().collect():
        load[shard] = n
    state = _table(
        spark,
        at=list(range(shards)),
        room=[max(0, q - n) for q, n in zip(quota, load, strict=True)],
        # The share of a shard's rows beyond its quota.
        excess=[_STEPS * max(0, n - q) // max(1, n) for q, n in zip(quota, load, strict=True)],
    )
    roomy = [s for s in range(shards) if load[s] < quota[s]] or [0]
    open_shards = _table(spark, number=list(range(len(roomy))), target=roomy)
    cells = linked.groupBy("text_id", F.col("shard").cast("long").alias("at")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Best where the whole text fits, then where most of it is, and of equals one by
    # hash, so that wishes go both ways; at most one cell for each shard.
    best = f"""array_max(transform(cells,
        c -> struct(copies - c.n <= c.room as fits, c.n as n,
                    xxhash64(text_id, c.at, {turn}) as draw, c.at as at))).at"""
    leaves = (F.size("cells") == 1) & (_draw(turn, "leave") < F.col("cells")[0]["excess"])
    homes = stored(
        cells.join(state, "at")
        .groupBy("text_id")
        .agg(
            F.sum("n").alias("copies"),
            F.collect_list(F.struct("n", "at", "room", "excess")).alias("cells"),
        )
        .withColumn("number", F.when(leaves, _draw(turn, "open", len(roomy))))
        .join(open_shards, "number", "left")
        .select("text_id", F.coalesce("target", F.expr(best)).alias("wish"), "cells")
    )
    wanted, leaving = [0] * shards, [0] * shards
    flows = homes.select("wish", F.inline("cells")).where("at <> wish")
    flows = flows.select(
        F.inline(
            F.expr(
                "array(struct(wish as shard, n as come, 0L as go), "
                "struct(at as shard, 0L as come, n as go))"
            )
        )
    )
    for r in flows.groupBy("shard").agg(F.sum("come"), F.sum("go")).collect():
        wanted[r[0]], leaving[r[0]] = r[1], r[2]
    cap = [q + q / 2 ** (turn + 1) for q in quota]
    share = granted(wanted, leaving, load, cap)
    grants = _table(spark, wish=list(range(shards)), granted=[int(s * _STEPS) for s in share])
    allowed = F.when(_draw(turn, "grant") < F.col("granted"), F.col("wish").cast("int"))
    moved = linked.join(
        homes.join(grants, "wish").select(F.col("text_id").alias("of"), allowed.alias("to")),
        F.col("text_id") == F.col("of"),
    )
    shard = F.coalesce("to", "shard").alias("shard")
    return moved.select(*[c for c in linked.columns if c != "shard"], shard), sum(wanted)


def propagated(linked: DataFrame, quota: list[int]) -> DataFrame:
    """``linked`` (``doc_id, text_id, shard``) after all rounds."""
    fewest, vain, turn = None, 0, 0
    while vain < 2:
        moved, wishes = _round(linked, turn, quota)
        if wishes < len(quota):
            break
        linked, turn = stored(moved), turn + 1
        vain = 0 if fewest is None or wishes < fewest else vain + 1
        fewest = wishes if fewest is None else min(fewest, wishes)
    return linked


def _listed(values: list[int], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), place + 1)


def _interval(ends: list[int]) -> Column:
    """Which interval ``rank`` lies in."""
    listed = F.array(*[F.lit(end).cast("long") for end in ends])
    return F.size(F.filter(listed, lambda end: end <= F.col("rank")))


def _whole_shards(
    large: DataFrame, total: int, least: int
) -> tuple[DataFrame, DataFrame, int]:
    """Texts of ``least`` rows and more, the smallest quota: rows that fill shards
    from 0 on with their slots, the rows left over, and how many shards are filled."""
    ranked = stored(_side_by_side(large, ["linked"], total))
    # Rows for at most as many texts as shards.
    texts = ranked.groupBy("text_id").agg(F.min("rank"), F.count(F.lit(1))).collect()
    begins, ends, shards, sizes, filled = [], [], [], [], 0
    for _, begin, copies in sorted(texts, key=lambda text: text[1]):
        for at in range(begin, begin + copies, least):
            size = min(least, begin + copies - at)
            begins.append(at)
            ends.append(at + size)
            shards.append(filled if size == least else -1)
            sizes.append(size)
            filled += size == least
    if not ends:
        empty = large.limit(0).withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
        return empty, large.limit(0), 0
    dealt = ranked.withColumn("of", _interval(ends)).withColumn(
        "shard", _listed(shards, F.col("of")).cast("int")
    )
    own = large.columns
    fixed = dealt.where("shard >= 0").select(
        *own, "shard", (F.col("rank") - _listed(begins, F.col("of"))).alias("slot")
    )
    rest = dealt.where("shard < 0").withColumn("copies", _listed(sizes, F.col("of")))
    return fixed, rest.select(*own), filled


def _limits(ranked: DataFrame, quota: list[int]) -> list[int]:
    """Ranks that each shard keeps: its quota, less a text that begins before its
    end and ends after it."""
    end = _listed(quota, F.col("shard"))
    # Two rows for each shard.
    ids: dict[int, list[bytes]] = {}
    for r in ranked.where((F.col("rank") == end) | (F.col("rank") == end - 1)).collect():
        ids.setdefault(r.shard, []).append(bytes(r.text_id))
    cut = {s: found[0] for s, found in ids.items() if len(found) == 2 and len(set(found)) == 1}
    limits = list(quota)
    if cut:
        begins = ranked.where(F.col("text_id").isin(list(set(cut.values()))))
        for s, text_id, begin in begins.groupBy("shard", "text_id").agg(F.min("rank")).collect():
            if cut.get(s) == bytes(text_id):
                limits[s] = begin
    return limits


def cut_share(placed: DataFrame) -> DataFrame:
    """One row: ``copies`` (linked documents), ``apart`` (those outside the shard
    that has most of their text)."""
    cells = placed.groupBy("text_id", "shard").agg(F.count(F.lit(1)).alias("n"))
    texts = cells.groupBy("text_id").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
    return texts.where("`all` > 1").agg(
        F.coalesce(F.sum("all"), F.lit(0)).alias("copies"),
        F.coalesce(F.sum(F.col("all") - F.col("most")), F.lit(0)).alias("apart"),
    )


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, text_id, law, shard, slot, grown_shard`` for
    every row of ``docs`` (``doc_id``, ``text``; other columns do not matter).

    Shards are ``0 .. shards - 1`` and their counts at most one apart; ``slot`` is
    gapless from 0 in each.  Null texts have only the overhead as size, and no
    links; empty texts are equal texts.  Repeated rows are placed one by one, and
    null ids like others.  Of the texts that fit a shard, fewer than ``shards`` are
    cut, and others fill whole shards.  No rows give no rows.
    """
    rows = stored(described(docs))
    total = rows.count()
    quota = quotas(total, shards)
    # Stored, as the homes below, so that a hot text's rows can be split.
    texts = stored(
        rows.where("text_id is not null")
        .groupBy("text_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(F.col("text_id").alias("of"), "copies")
    )
    marked = stored(rows.join(texts, F.col("text_id") == F.col("of"), "left").drop("of"))
    one = marked.withColumn("linked", F.col("copies").isNotNull())
    least = max(1, min(quota))
    fixed, rest, filled = _whole_shards(
        one.where("linked").where(F.col("copies") >= least), total, least
    )
    few = one.where("linked").where(F.col("copies") < least).union(rest)
    room = [q - least * (s < filled) for s, q in enumerate(quota)]
    begin = filled if filled < shards else 0
    linked = _spread(few, ["linked"], total).select(
        *marked.columns, (F.pmod("rank", F.lit(shards - begin)) + begin).cast("int").alias("shard")
    )
    linked = propagated(stored(linked), room)
    # What is still apart is laid side by side, in whole.
    parts = stored(
        linked.groupBy("text_id")
        .agg(F.min("shard").alias("low"), F.max("shard").alias("high"))
        .where("low < high")
        .select(F.col("text_id").alias("of"), F.lit(True).alias("split"))
    )
    told = stored(linked.join(parts, F.col("text_id") == F.col("of"), "left").drop("of"))
    ranked = stored(_side_by_side(told.where("split is null"), ["shard"], total).drop("split"))
    fits = F.col("rank") < _listed(_limits(ranked, room), F.col("shard"))
    slot = F.col("rank") + F.when(F.col("shard") < filled, least).otherwise(0)
    kept = ranked.where(fits).select(*rows.columns, "shard", slot.alias("slot"))
    kept = kept.union(fixed.select(*rows.columns, "shard", "slot"))
    # The others fill what is left, shard after shard.
    loads = {s: n for s, n in kept.groupBy("shard").count().collect()}
    begins, ends, taken, at = [], [], [], 0
    for s in range(shards):
        begins.append(at)
        at += quota[s] - loads.get(s, 0)
        ends.append(at)
        taken.append(loads.get(s, 0))
    homeless = stored(
        told.where("split")
        .select(*marked.columns)
        .union(ranked.where(~fits).select(*marked.columns))
        .withColumn("linked", F.lit(True))
    )
    alone = _spread(one.where("not linked"), ["linked"], total)
    alone = alone.withColumn("rank", F.col("rank") + homeless.count())
    columns = [*rows.columns, "rank"]
    loose = _side_by_side(homeless, ["linked"], total).select(*columns)
    loose = loose.union(alone.select(*columns))
    filling = loose.withColumn("shard", _interval(ends)).select(
        *rows.columns,
        "shard",
        (
            F.col("rank") - _listed(begins, F.col("shard")) + _listed(taken, F.col("shard"))
        ).alias("slot"),
    )
    return kept.union(filling).select(
        *rows.columns,
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
