r"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps what was
measured and a bit for each failed rule.  A policy is a set of rules under a
version: applying one, changing one or asking what a rule costs reads the
narrow ledger and no text.  All of it is DataFrame functions on one row at a
time, so nothing is shuffled.

Windows of three words are compared by 64 bits of their words, inside one
document only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails``, SQL over the measurements, is true."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("too_few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "5 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("word_length", 4, "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("capitals", 5, "2 * n_capitals > word_chars"),
    Rule("empty", 6, "n_words = 0"),
)
BASE = ("too_few_words", "repeated_windows")
# Versions are only ever added, so that an old decision can be repeated.
POLICIES: dict[int, tuple[str, ...]] = {
    1: (*BASE, "empty"),
    2: (*BASE, "empty", "symbols", "capitals", "repeated_lines", "word_length"),
}
CURRENT = 2


def mask(names: tuple[str, ...]) -> int:
    bits = {rule.name: rule.bit for rule in RULES}
    return sum(1 << bits[name] for name in names)


def _repeat_words() -> Column:
    """Words inside three-word windows that the document has twice or more.

    Sorted with their places, equal windows are neighbours; their places, sorted
    again, cover up to three words each before the next begins.
    """
    return F.expr(
        """
        case when size(array_distinct(windows)) = size(windows) then 0L else
          aggregate(
            transform(
              array(sort_array(transform(windows, (x, i) -> struct(x as h, i as i)))),
              s -> aggregate(
                transform(
                  array(sort_array(transform(
                    filter(s, (e, k) -> e.h = get(s, k - 1).h or e.h = get(s, k + 1).h),
                    e -> e.i))),
                  p -> aggregate(
                    transform(p, (x, k) -> least(3, coalesce(get(p, k + 1) - x, 3))),
                    0L, (sum, n) -> sum + n)),
                0L, (sum, n) -> sum + n)),
            0L, (sum, n) -> sum + n)
        end
        """
    )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements, all ``long``; null texts measure 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", WHITE), "").alias("words"),
        F.filter(
            F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
        ).alias("lines"),
    )
    windows = F.expr(
        "transform(slice(words, 1, greatest(size(words) - 2, 0)), "
        "(w, i) -> xxhash64(w, words[i + 1], words[i + 2]))"
    )
    counted = words.select("doc_id", "text", "words", "lines", windows.alias("windows"))

    def without(pattern: str) -> Column:
        return F.char_length(F.regexp_replace("text", pattern, ""))

    measures = {
        "n_words": F.size("words"),
        "word_chars": F.char_length(F.array_join("words", "")),
        "n_symbols": F.char_length("text") - without(r"[#*$%&|<>]"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(),
        "n_lines": F.size("lines"),
        "n_capitals": F.char_length("text") - without("[A-Z]"),
    }
    return counted.select("doc_id", *[c.cast("long").alias(name) for name, c in measures.items()])


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failed``, the bits of the failed rules,
    for every row of ``docs`` (``doc_id``, ``text``; other columns do not matter).

    Null, empty and blank texts have no words and fail as too short and empty.
    Rows are judged one by one, also if they repeat or have no id.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    failed = reduce(Column.bitwiseOR, bits).cast("long")
    return measured(docs).withColumn("failed", failed)


def verdict(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    return entries.withColumn(
        "base_failed", F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    ).withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablations(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """``rule, n_failed, n_only, kept_without``: for each rule of a policy, the
    documents it fails, those no other rule fails, and how many would be kept
    without it.  Documents are first counted by their bits, of which there are at
    most two to the number of rules."""
    names = POLICIES[version]
    policy = mask(names)
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.explode(
        F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask((n,))).alias("bit")) for n in names])
    )
    own = F.col("rule.bit").cast("long")
    has = F.col("bits").bitwiseAND(own) != 0

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return (
        patterns.select("bits", "n", rules.alias("rule"))
        .groupBy(F.col("rule.rule").alias("rule"))
        .agg(
            count(has).alias("n_failed"),
            count(F.col("bits") == own).alias("n_only"),
            count((F.col("bits") == own) | (F.col("bits") == 0)).alias("kept_without"),
        )
    )
