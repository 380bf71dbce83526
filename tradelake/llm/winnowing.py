"""Benchmark contamination by winnowing, with DataFrame functions only.

Of every run of w neighbouring k-grams of words the least hash is kept as a fingerprint.  With
k + w - 1 = 13 each span of 13 words holds one of its own, chosen from the span alone, so a
benchmark window and its copy in a document have a fingerprint in common: documents
without a common fingerprint hold no window.  In the others the hits are extended to whole
windows and compared word by word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.names import unused

from tradelake.session import stage

WINDOW = 13
# Everything of ASCII that is no lower-case letter or digit parts words
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case; other letters stay as they are."""
    plain = F.octet_length(text) == F.length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lower, GAPS), "")


def spans(w: Column, length: int) -> Column:
    """Every run of ``length`` words, as a text of its words."""
    return F.when(F.size(w) >= length, F.transform(F.sequence(F.lit(1), F.size(w) - (length - 1)),
                                                   lambda i: F.array_join(F.slice(w, i, length), " ")))


def fingerprints(w: Column, length: int) -> Column:
    """The winnowed fingerprints of the words for spans of ``length`` words."""
    k = length // 2 + 1
    width = length - k + 1

    def grams(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)), lambda i: F.xxhash64(F.slice(h, i, k)))

    def least(g: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(g) - (width - 1)), lambda i: F.array_min(F.slice(g, i, width)))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    chosen = let(hashes, lambda h: let(grams(h), lambda g: F.array_distinct(least(g))))
    return F.when(F.size(w) >= length, chosen)


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """(item_id, span, length) of the items' windows: an item of fewer words, but not none, is one."""
    own = items.select(F.col("item_id"), words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("w"))
    own = own.filter(F.size("w") > 0)
    long = own.filter(F.size("w") >= window).select("item_id", F.explode(spans(F.col("w"), window)).alias("span"), F.lit(window).alias("length"))
    short = own.filter(F.size("w") < window).select("item_id", F.array_join("w", " ").alias("span"), F.size("w").alias("length"))
    return long.unionAll(short).distinct()


def _worded(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.md5("text").alias("digest"), words(F.col("text")).alias("w"))


def _hits(rows: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(digest, item_ids, hits, n_words, n_hit) of the texts that hold a window."""
    bench = stage(windows_of(items, window), "windows")
    lengths = sorted(r.length for r in bench.select("length").distinct().collect())  # at most ``window`` numbers
    if not lengths:
        bench, lengths = bench.limit(0), [window]

    def prints(df: DataFrame, w: Column, *columns: str) -> DataFrame:
        own = F.array(*(F.struct(F.lit(n).alias("length"), fingerprints(w, n).alias("prints")) for n in lengths))
        each = df.select(*columns, F.explode(own).alias("own")).select(*columns, "own.length", F.explode("own.prints").alias("print"))
        return each

    known = prints(bench.select(F.split("span", " ").alias("w")).distinct(), F.col("w")).distinct()
    suspects = prints(rows, F.col("w"), "digest").join(known, ["length", "print"], "left_semi").select("digest").distinct()
    suspects = stage(rows.join(suspects, "digest", "left_semi").groupBy("digest").agg(F.any_value("w").alias("w")), "suspects")

    # extension: every window of a suspect against the benchmark's, as whole texts
    own = F.array(*(F.struct(F.lit(n).alias("length"), spans(F.col("w"), n).alias("spans")) for n in lengths))
    places = suspects.select("digest", F.explode(own).alias("own")).select(
        "digest", "own.length", F.posexplode("own.spans").alias("at", "span"))
    by_span = bench.groupBy("span", "length").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = places.join(by_span, ["span", "length"])
    hits = found.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("at", (F.col("at") + F.col("length")).alias("end")))).alias("at"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    # spans in order of their start; one that begins inside the last joins it
    merged = F.aggregate("at", F.array().cast("array<struct<start:int,end:int>>"), lambda done, x: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["at"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(F.struct(x["at"].alias("start"), x["end"].alias("end"))))))
    hits = hits.select("digest", "item_ids", merged.alias("hits"))
    n_hit = F.aggregate("hits", F.lit(0), lambda a, x: a + x["end"] - x["start"]).cast("long")
    return hits.join(suspects.select("digest", F.size("w").alias("n_words")), "digest").withColumn("n_hit", n_hit)


def _too_much(percent: int) -> Column:
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """How far each document holds windows of benchmark items.

    Returns per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a window), item_ids
    (items with an occurring window, as sorted strings), hits (the maximal hit spans as word numbers
    [start, end)) and contaminated (some word is hit, and hit words make ``percent`` of all or more).
    A window is ``window`` neighbouring words of an item; an item of fewer words, but not none, is one
    window.  Null and empty texts have no words and are never contaminated.  Results depend on
    the text alone, so ties, repeated rows and rows without doc_id are no special case;
    other columns are not looked at.  An empty benchmark hits nothing.
    """
    rows = _worded(docs)
    hits = _hits(rows, items, window).drop("n_words")
    out = rows.select("doc_id", "digest", F.size("w").cast("long").alias("n_words")).join(hits, "digest", "left")
    out = out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("hits", F.array().cast("array<struct<start:int,end:int>>")).alias("hits"), _too_much(percent).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, whole and unchanged."""
    own = unused(docs, "_digest")[0]
    bad = _hits(_worded(docs), items, window).filter(_too_much(percent)).select(F.col("digest").alias(own))
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.withColumn(own, digest).join(bad, own, "left_anti").select(*docs.columns)
