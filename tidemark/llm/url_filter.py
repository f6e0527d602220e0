"""URL filter: rules, then naive Bayes over segmented host words and path words.

Rules (a domain and a path prefix) judge what they fit; the longest wins.  The rest
is judged by multinomial naive Bayes.  Its blocked class are urls that a rule blocks,
and urls without a rule whose host has a seed word, with all their words; the other
class are urls that a rule allows and the rest of those without one.  The share of
seeded urls among those without a rule is the prior.  Words that rules name are no
evidence, as they would only repeat the rules.

Host names run words together, so the letter runs of a host are cut into words by
Viterbi search over a unigram model of the pages' own words.  Both models are whole
tables: every substring of a run that could be a word is joined with the word counts,
and every word of a url with its odds, so nothing is hashed or left out as rare.
Tables measured to be small are broadcast; else joins split hot words.  Odds are
whole numbers of millionths, so that their sums do not depend on any order.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import prepare, stored

BLOCK, ALLOW = "block", "allow"

# A label of a host name has at most 63 letters, so that no longer word is in one.
LABEL_LETTERS = 63
SMOOTHING = 0.5
MILLION = 1_000_000
# Words of hosts whose urls train the blocked class; the unigram model has them with
# at least this share of all words.
SEEDS = ("ads", "adult", "bets", "betting", "casino", "loan", "pills", "poker", "porn")
SEEDS += ("replica", "sex", "spam", "viagra", "warez", "xxx")
SEED_SHARE = 2e-5

# Words that a task counts before it hands them on, and rows of a table that is
# broadcast (a word and a number: some 100 bytes).
HELD = 1 << 18
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule(BLOCK, "net/"),
    Rule(ALLOW, "example.net/en/"),
    Rule(BLOCK, "example.com/de/"),
    Rule(ALLOW, "org/fr/"),
)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host in lower case (A-Z) and path; both empty without ``://``."""
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.encode().lower().decode(), path


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[Rule, ...]
    by_host: dict[str, list[Rule]] = field(default_factory=dict)

    def __post_init__(self):
        for rule in self.rules:
            self.by_host.setdefault(rule.host, []).append(rule)

    def match(self, host: str, path: str) -> Rule | None:
        """The longest rule for the host or a parent domain whose path fits."""
        found, rest = [], host
        while rest:
            found += [r for r in self.by_host.get(rest, []) if path.startswith(r.path)]
            rest = rest.partition(".")[2]
        return max(found, key=lambda r: (len(r.text), r.text), default=None)

    def words(self) -> frozenset[str]:
        """What the rules name."""
        return frozenset(w for r in self.rules for w in re.split(r"[^a-z0-9]+", r.text) if w)


def unknown_cost(letters: int, total: int) -> float:
    """An unknown word costs more the longer it is."""
    return math.log(10 * max(total, 1)) + 2.3 * letters


def segment(label: str, known: Iterable[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest split of ``label`` into words.  ``known`` are ``start, end, n`` of
    its parts that are words, which ``total`` words of the pages have n times."""
    counts = {(start, end): n for start, end, n in known}
    best, last = [0.0], [0]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - LABEL_LETTERS), end):
            n = counts.get((start, end))
            cost = math.log(total / n) if n else unknown_cost(end - start, total)
            options.append((best[start] + cost, start))
        value, start = min(options)
        best.append(value)
        last.append(start)
    words, end = [], len(label)
    while end:
        words.append(label[last[end] : end])
        end = last[end]
    return words[::-1]


def host_labels(host: str) -> list[str]:
    """The letter runs of a host."""
    return [run for run in re.split(r"[\W\d_]+", host) if run]


def path_words(path: str, ignored: frozenset[str]) -> list[str]:
    """Words of a path, marked as such; no numbers."""
    words = [w.lower() for w in re.split(r"[\W_]+", path) if w]
    return [f"/{w}" for w in words if w not in ignored and not w.isdigit()]


def _parted(rules: RuleSet):
    ignored = rules.words()

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch["url"].to_pylist():
                host, path = host_and_path(url)
                rule = rules.match(host, path)
                labels, steps = host_labels(host), path_words(path, ignored)
                rows.append((host, path, rule and rule.text, rule and rule.verdict, labels, steps))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.string()] * 4 + [pa.list_(pa.string())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"]]
                + [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["page_id", "host", "path", "rule", "ruled", "labels", "steps"],
            )

    return parted


def _urls(pages: DataFrame, rules: RuleSet) -> DataFrame:
    """``page_id, host, path, rule, ruled, labels, steps, row``; ``row`` numbers them."""
    prepare(pages.sparkSession)
    schema = (
        "page_id long, host string, path string, rule string, ruled string, "
        "labels array<string>, steps array<string>"
    )
    return stored(
        pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
        .mapInArrow(_parted(rules), schema)
        .withColumn("row", F.monotonically_increasing_id())
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def handed_on() -> pa.RecordBatch:
        words = [word.decode() for word in counts]
        numbers = pa.array(list(counts.values()), pa.int64())
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), numbers], ["word", "n"])

    for batch in batches:
        for html in batch["html"].to_pylist():
            plain = re.sub(rb"<[^>]*>", b" ", (html or "").encode().lower())
            counts.update(re.findall(rb"[a-z]+", plain))
        if len(counts) > HELD:
            yield handed_on()
    yield handed_on()


@dataclass(frozen=True)
class Words:
    """The unigram model: ``word, n`` of all words that a label can hold, and how
    many there are with longer ones."""

    counts: DataFrame
    total: int


def word_model(pages: DataFrame) -> Words:
    """The unigram model of all words in ``pages.html``, and the seeds."""
    prepare(pages.sparkSession)
    counts = stored(
        pages.select(F.col("html").cast("string").alias("html"))
        .mapInArrow(_count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    least = max(1, round(SEED_SHARE * total))
    seeds = pages.sparkSession.createDataFrame([(w, least) for w in SEEDS], "word string, n long")
    held = counts.where(F.char_length("word") <= LABEL_LETTERS).unionByName(seeds)
    return Words(stored(held.groupBy("word").agg(F.max("n").alias("n"))), total)


def _few(rows: DataFrame) -> DataFrame:
    """A stored table, broadcast if it is counted to be small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (label, i, j, label[i:j])
            for label in batch["label"].to_pylist()
            for j in range(1, len(label) + 1)
            for i in range(max(0, j - LABEL_LETTERS), j)
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["label", "start", "end", "word"],
        )


def _segmented(total: int):
    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [
                segment(label, [(k["start"], k["end"], k["n"]) for k in known or []], total)
                for label, known in zip(*map(pa.Array.to_pylist, batch.columns), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array(words, pa.list_(pa.string()))], names=["label", "words"]
            )

    return segmented


def segments(labels: DataFrame, words: Words) -> DataFrame:
    """``label, words`` for each distinct ``label``."""
    distinct = stored(labels.select("label").distinct())
    parts = distinct.mapInArrow(_substrings, "label string, start int, end int, word string")
    known = (
        parts.join(_few(words.counts), "word")
        .groupBy("label")
        .agg(F.collect_list(F.struct("start", "end", "n")).alias("known"))
    )
    return distinct.join(known, "label", "left").mapInArrow(
        _segmented(words.total), "label string, words array<string>"
    )


def host_words(urls: DataFrame, words: Words, ignored: frozenset[str]) -> DataFrame:
    """``host, words`` for each distinct host: its labels' words in order, less those
    that are ``ignored``."""
    hosts = urls.select("host", "labels").distinct()
    placed = hosts.select("host", F.posexplode("labels").alias("pos", "label"))
    found = stored(segments(placed, words))
    listed = F.sort_array(F.collect_list(F.struct("pos", "words")))
    joined = (
        placed.join(_few(found), "label")
        .groupBy("host")
        .agg(F.flatten(F.transform(listed, lambda p: p["words"])).alias("words"))
    )
    named = F.array(*[F.lit(w) for w in sorted(ignored)]).cast("array<string>")
    kept = F.filter("words", lambda w: ~F.array_contains(named, w))
    return stored(joined.select("host", kept.alias("words")))


@dataclass(frozen=True)
class Model:
    """The rules, the unigram model, ``word, odds`` of blocking (in millionths of the
    natural logarithm) and the odds before any word."""

    rules: RuleSet
    words: Words
    odds: DataFrame
    prior: int


def log_odds(blocked: Column, allowed: Column, all_blocked: int, all_allowed: int) -> Column:
    """Of a word that the classes have so often, of so many words each."""
    of = math.log((all_allowed + SMOOTHING) / (all_blocked + SMOOTHING))
    ratio = F.log((blocked + SMOOTHING) / (allowed + SMOOTHING)) + of
    return F.round(ratio * MILLION).cast("long")


def train(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """Fit on every url of ``pages`` (``url, html``)."""
    judged = RuleSet(tuple(rules))
    words, urls = word_model(pages), _urls(pages, judged)
    of_host = host_words(urls, words, judged.words())
    seeds = F.array(*map(F.lit, SEEDS))
    known = urls.join(_few(of_host), "host", "left")
    own = F.coalesce("words", F.array().cast("array<string>"))
    seeded = F.col("rule").isNull() & F.arrays_overlap(own, seeds)
    rows = known.select(
        F.col("rule").isNull().alias("open"),
        ((F.col("ruled") == BLOCK) | seeded).alias("blocked"),
        F.concat(own, "steps").alias("words"),
    ).withColumn("blocked", F.coalesce("blocked", F.lit(False)))
    counts = stored(
        rows.select("blocked", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if("blocked").alias("blocked"), F.count_if(~F.col("blocked")).alias("allowed"))
    )
    seen, bad = rows.agg(
        F.count_if("open"), F.count_if(F.col("open") & F.col("blocked"))
    ).first()
    sums = counts.agg(F.sum("blocked"), F.sum("allowed")).first()
    odds = log_odds(F.col("blocked"), F.col("allowed"), *[n or 0 for n in sums])
    # Add one: neither class is impossible.
    prior = round(math.log((bad + 1) / (seen - bad + 1)) * MILLION)
    return Model(judged, words, stored(counts.select("word", odds.alias("odds"))), prior)


def filter_urls(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, host, path, rule, verdict, words, score`` for every row of
    ``pages`` (``page_id``, ``url``; other columns do not matter).

    ``score`` is the logarithm of the odds of blocking; a url without a rule is blocked
    above 0.  Words that the model has not seen are no evidence.  A null or malformed
    url has an empty host and path, fits no rule and has no words: the prior judges
    it.  Of rules that fit equally long, the last by name wins; splits of a host that
    are equally likely are decided by the earliest start.  Rows are judged one by one,
    also if they repeat.  No rows give no rows.
    """
    urls = _urls(pages, model.rules)
    odds = _few(model.odds)
    of_host = host_words(urls, model.words, model.rules.words())
    host_scores = (
        of_host.select("host", F.explode("words").alias("word"))
        .join(odds, "word")
        .groupBy("host")
        .agg(F.sum("odds").alias("host_score"))
    )
    hosts = stored(of_host.join(host_scores, "host", "left"))
    path_scores = (
        urls.select("row", F.explode("steps").alias("word"))
        .join(odds, "word")
        .groupBy("row")
        .agg(F.sum("odds").alias("path_score"))
    )
    zero = F.lit(0).cast("long")
    score = F.lit(model.prior) + F.coalesce("host_score", zero) + F.coalesce("path_score", zero)
    judged = F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)
    own = F.coalesce("words", F.array().cast("array<string>"))
    return (
        urls.join(_few(hosts), "host", "left")
        .join(path_scores, "row", "left")
        .withColumn("score", score)
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", judged).alias("verdict"),
            F.concat(own, "steps").alias("words"),
            (F.col("score") / MILLION).alias("score"),
        )
    )
