"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule is cheap or dear and rejects much or little.  Both are measured on a sample, and the
rules run in the order of rejections per second: a text that an early rule rejects never
reaches the later ones.  The order changes the cost, not the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.session import stage

SAMPLE_ROWS = 2000

# What parts words, and the signs that count as symbols
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words(text), "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(text: Column, k: int = 3) -> Column:
    """Words in windows of k words that the text holds twice or more.

    The windows are sorted with their places; those equal to a neighbour are repeated.  In order of
    place each repeated window adds the words that the one before it did not cover.
    """
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.struct(
            F.array_join(F.slice(w, i, k), " ").alias("words"), i.alias("at")))

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, i: (
            (i > 0) & (x["words"] == F.get(s, i - 1)["words"])) | F.coalesce(x["words"] == F.get(s, i + 1)["words"], F.lit(False)))

    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda p, i: F.when(i == 0, k).otherwise(
            F.least(F.lit(k), p - F.get(places, i - 1)))), F.lit(0), lambda a, b: a + b)

    def count(w: Column) -> Column:
        return let(F.sort_array(windows(w)), lambda s: let(
            F.sort_array(F.transform(repeated(s), lambda x: x["at"])), covered))

    return let(words(text), lambda w: F.when(F.size(w) > k, count(w)).otherwise(0)).cast("long")


COUNTS: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
}
Counts = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a row that has to go; it is given a function from a count's name to its column."""

    name: str
    rejects: Callable[[Counts], Column]


BASE = [
    Rule("few_words", lambda c: c("n_words") < MIN_WORDS),
    Rule("repeated_words", lambda c: 100 * c("n_repeat_words") > MAX_REPEATED_PERCENT * c("n_words")),
]
# What the cascade adds to the base: texts of symbols, of repeated lines, of runs of letters or single ones
MORE = [
    Rule("symbols", lambda c: c("n_symbols") > c("n_words")),
    Rule("duplicate_lines", lambda c: 10 * c("n_dup_lines") > c("n_words")),
    Rule("short_words", lambda c: c("word_chars") < 2 * c("n_words")),
    Rule("long_words", lambda c: c("word_chars") > 20 * c("n_words")),
]
DEFAULT = [*BASE, *MORE]


def from_text(text: Column) -> Counts:
    """Counts that are worked out from a text when, and only when, a rule asks for them."""
    value = F.coalesce(text.cast("string"), F.lit(""))
    return lambda name: COUNTS[name](value)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def value(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS, seed: int = 17) -> list[Measured]:
    """Seconds and rejected share of each rule on a sample of about ``rows`` rows.

    One pass over the table writes the sampled texts to the shared folder; each rule is timed on
    those, after a run that compiles it.
    """
    fraction = min(1.0, rows / max(1, docs.count()))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    sample = stage(docs.select(text).sample(fraction, seed).coalesce(8), "sample")
    out = []
    for rule in rules:
        share = F.avg(rule.rejects(from_text(F.col("text"))).cast("double"))
        seconds, rejected = [], 0.0
        for _ in range(2):
            began = time.perf_counter()
            rejected = sample.agg(share).first()[0] or 0.0
            seconds.append(time.perf_counter() - began)
        out.append(Measured(rule, min(seconds), rejected))
    return out


def ordered(measured: list[Measured]) -> list[Rule]:
    """The rules by rejections per cost, the most first; equals keep their order."""
    return [m.rule for m in sorted(measured, key=lambda m: -m.value)]


def cascade(counts: Counts, rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are not worked out."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        out = out.when(rule.rejects(counts), F.lit(rule.name))
    return out


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``rejected_by``: the rule that rejects the row, null for a row to keep.

    A null or empty text has no words and is rejected.  Each row is judged by itself, so repeated rows
    and ties have equal verdicts; an empty table stays empty.  A column rejected_by of the input is
    replaced, others stay.  If several rules reject a row, which one is named depends on the
    measured order; whether one does, does not.
    """
    rules = DEFAULT if rules is None else rules
    return docs.withColumn("rejected_by", cascade(from_text(F.col("text")), ordered(measure(docs, rules))))


def counted(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed (one of the base rules rejects) and kept.

    For those who want the counts of every row; the cascade then reads them.  Rows as in ``judged``.
    """
    rules = DEFAULT if rules is None else rules
    order = ordered(measure(docs, rules))
    counts = from_text(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(counts(n).alias(n) for n in COUNTS))
    failed = F.lit(False)
    for rule in BASE:
        failed = failed | rule.rejects(F.col)
    return rows.select("*", failed.alias("base_failed"), (~failed & cascade(F.col, order).isNull()).alias("kept"))
