r"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text, its blob.
The ledger has a row for each scan of a blob: the rules it was scanned with, by
kind and version, and the spans found.  A scan takes only pairs of blob and rule
that no ledger row has: a text that many paths or versions share is scanned
once, a later run scans new texts, and a rule of a new version meets all texts
again while the others do not.  Findings are joined back to all paths by blob.

What is shuffled to find unseen pairs are addresses; the text of one version of
each unseen blob then moves once.  All of it is DataFrame functions: a pattern
cuts the text into matches and the gaps between them, whose lengths add up to
offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stored import stored


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first and not overlapping, of which
    ``group`` has at least ``least`` code points.  Change ``version`` with the
    pattern: it tells the ledger that texts have to be scanned again."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}/{self.version}"


# A run of characters is matched whole, so a run that is too short can be left
# to the pattern (access, hex).  What follows an assignment may itself hold the
# start of another, so that one is measured after it has matched.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        least=8,
        group=2,
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
# Headers of private keys, and signed web tokens.
FURTHER = (
    Rule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + FURTHER

# Spans in a ledger row, and as findings.
ENTRY_SPANS = "array<struct<start: int, rule: string, end: int>>"
FOUND_SPANS = "array<struct<start: int, kind: string, end: int>>"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _blob() -> Column:
    return F.unhex(F.sha2(_text(), 256)).alias("blob")


def addresses(versions: DataFrame, path: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``path`` columns and ``blob`` of every row."""
    return versions.select(*path, _blob())


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule]) -> DataFrame:
    """``blob, at, todo`` for each distinct blob that the ledger lacks a scan of:
    the smallest ``at`` (which of its versions to read) and the missing rules."""
    wanted = F.array(*[F.lit(rule.id) for rule in rules])
    distinct = blobs.groupBy("blob").agg(F.min("at").alias("at"))
    if ledger is None:
        return distinct.withColumn("todo", wanted)
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
    return (
        distinct.join(seen, "blob", "left")
        .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array())))
        .where("size(todo) > 0")
        .drop("seen")
    )


def _matches(rule: Rule) -> Column:
    """``gap, size, measured`` of every match in ``text``: code points since the
    match before, of the match, and of its measured group."""
    pattern = F.lit(rule.pattern)
    gaps = F.split("text", rule.pattern, -1)
    zipped = F.arrays_zip(
        gaps.alias("gap"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("group"),
    )
    lengths = F.transform(
        zipped,
        lambda m: F.struct(
            F.length(m["gap"]).alias("gap"),
            F.length(m["match"]).alias("size"),
            F.length(m["group"]).alias("measured"),
        ),
    )
    # What follows the last match is a gap without one.
    found = F.filter(lengths, lambda m: m["size"].isNotNull())
    return F.when(F.array_contains("todo", rule.id) & F.col("text").rlike(rule.pattern), found)


def spans(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, spans`` for the rows of ``texts`` (``blob, text, todo``) in which a
    rule of ``todo`` finds something; spans in order, the end exclusive."""
    by_rule = F.array(
        *[
            F.struct(F.lit(i).alias("number"), _matches(rule).alias("matches"))
            for i, rule in enumerate(rules)
        ]
    )
    each = (
        texts.select("blob", F.monotonically_increasing_id().alias("row"), F.inline(by_rule))
        .where("matches is not null")
        .select("blob", "row", "number", F.posexplode("matches").alias("pos", "m"))
        .select("blob", "row", "number", "pos", "m.*")
        # A blob's matches stay together from here on.
        .repartition("blob")
    )
    before = Window.partitionBy("blob", "row", "number").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    start = (F.col("end") - F.col("size")).alias("start")
    least = F.element_at(F.array(*[F.lit(rule.least) for rule in rules]), F.col("number") + 1)
    rule = F.element_at(F.array(*[F.lit(rule.id) for rule in rules]), F.col("number") + 1)
    found = (
        each.withColumn("end", end.cast("int"))
        .where(F.col("measured") >= least)
        .groupBy("blob")
        # A set, as a version may be listed twice.
        .agg(F.collect_set(F.struct(start, "number", rule.alias("rule"), "end")).alias("found"))
    )
    ordered = F.transform(
        F.sort_array("found"), lambda s: F.struct(s["start"], s["rule"], s["end"])
    )
    return found.select("blob", ordered.alias("spans"))


def scan(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    path: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """New ledger rows ``blob, scanned, spans`` for the rows of ``versions`` (the
    ``path`` columns and ``text``; other columns do not matter).

    Only pairs of blob and rule that ``ledger`` (such rows of earlier scans) lacks
    are scanned; nothing unseen gives no rows.  A blob without findings has a row
    too, with no spans.  Null text is empty.  Rows that repeat, and paths that are
    null, are read like others.  The caller appends the result to its ledger.
    """
    at = F.xxhash64(*path).alias("at")
    new = stored(unseen(versions.select(_blob(), at), ledger, rules))
    # One version of each blob; the narrow side is hashed, texts are not sorted.
    texts = versions.select(_blob(), at, _text().alias("text")).join(
        new.hint("shuffle_hash"), ["blob", "at"]
    )
    found = spans(texts.select("blob", "text", "todo"), rules)
    return stored(
        new.join(found, "blob", "left").select(
            "blob",
            F.col("todo").alias("scanned"),
            F.coalesce("spans", F.array().cast(ENTRY_SPANS)).alias("spans"),
        )
    )


def findings(
    versions: DataFrame,
    ledger: DataFrame,
    rules: Sequence[Rule] = RULES,
    path: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``path`` columns and ``spans`` (``start, kind, end``) of every row of
    ``versions``, whenever and wherever its text was scanned: those of the given
    rules and versions, by start and then as the rules are listed."""
    ids, kinds = [rule.id for rule in rules], F.array(*[F.lit(rule.kind) for rule in rules])
    order = F.array(*map(F.lit, ids))
    known = (
        ledger.where("size(spans) > 0")
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("spans")).alias("all"))
    )
    numbered = F.transform(
        F.filter("all", lambda s: s["rule"].isin(ids)),
        lambda s: F.struct(
            s["start"], F.array_position(order, s["rule"]).alias("number"), s["end"]
        ),
    )
    named = F.transform(
        # Of a blob that was scanned twice at once, each span is told once.
        F.sort_array(F.array_distinct(numbered)),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.element_at(kinds, s["number"].cast("int")).alias("kind"),
            s["end"].alias("end"),
        ),
    )
    nothing = F.array().cast(FOUND_SPANS)
    return addresses(versions, path).join(
        known.select("blob", named.alias("spans")), "blob", "left"
    ).select(*path, F.coalesce("spans", nothing).alias("spans"))


def _listed(found: Column) -> Column:
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """``findings`` of documents as counts of the base rules, the digest of their
    spans, and all spans."""
    base = [rule.kind for rule in BASE]

    def count(kind: str) -> Column:
        found = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(found).cast("long").alias(f"n_{kind}")

    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(_listed(own), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
