"""Spelling variants: words one edit apart, found by an index of grams of variable length.

A gram is *frequent* if more words of the vocabulary hold it than a list may be long.  The
dictionary is the set of frequent grams: it tells where a gram has to be made longer.  A word,
between a begin and an end mark, is decomposed into one gram per position, the shortest that
is not frequent (or ``LONGEST`` characters, or all that is left).  A gram depends on its own
characters alone, so an edit affects only the grams that cover its place.  The largest number of
grams that cover one place is the word's bound: at most so many of its grams are lost in a word
one edit away, and of any ``bound + 1`` grams at least one stays.  So only the lists of the
``bound + 1`` rarest grams of each word have to be merged, and what meets there is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.ship import ship
from tradelake.session import stage

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 199
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
SHORTEST, LONGEST = 2, 6
LIST = 32
DICTIONARY = 200_000
BEGIN, END = "\x01", "\x02"


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of all texts with their occurrences.

    Words are the runs of Latin letters, A-Z in lower case.  One run in ``slip``, by the CRC of
    doc_id and run, loses a letter, which plants misspellings (0: none does).  Words
    shorter than ``least_length`` or rarer than ``least_count`` are left out.  A null or empty text has no
    words; a row without doc_id has an empty one in its CRC; repeated rows count each time.
    """
    lower = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    word = F.col("run")
    if slip:
        runs = runs.select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")).alias("h"))
        at = F.pmod(F.col("h"), F.length("run"))
        cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
        word = F.when(F.col("h") % slip == 0, cut).otherwise(word)
    counted = runs.select(word.alias("word")).filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def marked(word: Column) -> Column:
    return F.concat(F.lit(BEGIN), word, F.lit(END))


def dictionary(words: DataFrame, longest: int = LONGEST, shortest: int = SHORTEST, least: int = LIST,
               entries: int = DICTIONARY) -> set[str]:
    """The frequent grams of a vocabulary: at most ``entries``, whatever its size.

    A gram is frequent above ``least`` occurrences, or above as many as it takes that no more
    than ``entries`` grams can reach them: the occurrences of all grams, divided by
    ``entries``.
    """
    length = F.length("word") + 2
    sizes = [F.greatest(F.lit(0), length - q + 1) for q in range(shortest, longest)]
    total = words.agg(F.sum(sum(sizes[1:], sizes[0]).cast("long"))).first()[0] if sizes else 0
    if not total:
        return set()
    limit = max(least, math.ceil(total / entries))
    text, grams = marked(F.col("word")), []
    for q in range(shortest, longest):
        at = F.sequence(F.lit(1), F.length("word") + 2 - q + 1)
        grams.append(F.when(F.length("word") + 2 >= q, F.transform(at, lambda i, q=q: F.substring(text, i, F.lit(q)))))
    found = words.select(F.explode(F.concat(*(F.coalesce(g, F.array().cast("array<string>")) for g in grams))).alias("gram"))
    return {r.gram for r in found.groupBy("gram").count().filter(F.col("count") > limit).select("gram").collect()}


def grams_of(word: str, frequent: set[str], shortest: int = SHORTEST, longest: int = LONGEST) -> tuple[list[str], int]:
    """The gram at each place of the marked word, and the most grams that one edit can affect."""
    text = BEGIN + word + END
    n, grams = len(text), []
    cover = np.zeros(n + 1, np.int64)
    for p in range(n - shortest + 1):
        q = shortest
        while q < longest and p + q < n and text[p:p + q] in frequent:
            q += 1
        grams.append(text[p:p + q])
        cover[p] += 1
        cover[p + q] -= 1
    return grams, int(np.cumsum(cover).max())


def decomposed(words: DataFrame, frequent: set[str], shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(word, n, gram, at, bound): the grams of each word with their places."""
    ship(words.sparkSession)
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                cut = [grams_of(w, own, shortest, longest) for w in part.column(0).to_pylist()]
                sizes = np.array([len(g) for g, _ in cut], np.int64)
                row = pa.array(np.repeat(np.arange(len(cut)), sizes))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(row), part.column(1).take(row),
                    pa.array([g for grams, _ in cut for g in grams], pa.string()),
                    pa.array(np.concatenate([np.arange(s) for s in sizes]) if len(cut) else [], pa.int32()),
                    pa.array(np.repeat([b for _, b in cut], sizes), pa.int32())],
                    ["word", "n", "gram", "at", "bound"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, gram string, at int, bound int")


def near_pairs(words: DataFrame, frequent: set[str], least_length: int = LEAST_LENGTH, shortest: int = SHORTEST,
               longest: int = LONGEST, long_list: int = LIST) -> DataFrame:
    """(a, a_n, b, b_n): every two words one edit apart, once; b is no shorter than a.

    The shared gram lies left of the edit, and then at the same place in both words, or right of it, and then at
    a place that differs by the difference in length; so a list is split by place and length.  The
    words of a list longer than ``long_list`` are split by all that comes before the gram
    (edit to the right of it) and by all that comes after (edit to the left): what the two words have in
    common there.  No split loses a pair.  Keys are hashes; a collision brings words together that
    verification parts again.
    """
    if least_length + 3 - shortest <= longest:
        raise ValueError("grams this long leave short words without an unaffected gram")
    postings = stage(decomposed(words, frequent, shortest, longest), "grams")
    sizes = postings.groupBy("gram").agg(F.count("*").alias("size"))
    ranked = postings.join(sizes, "gram").groupBy("word", "n", "bound").agg(
        F.sort_array(F.collect_list(F.struct("size", "gram", "at"))).alias("grams"))
    rare = ranked.select("word", "n", F.length("word").alias("l"), F.explode(F.slice("grams", F.lit(1), F.col("bound") + 1)).alias("g"))
    rare = rare.select("word", "n", "l", "g.*", marked(F.col("word")).alias("text"))
    before = F.substring("text", F.lit(1), F.col("at"))
    after = F.substring("text", F.col("at") + 1 + F.length("gram"), F.col("l"))
    hot = F.col("size") > long_list

    def left(l: Column) -> Column:  # the edit is to the right
        return F.xxhash64(F.lit("left"), "gram", l, "at", F.when(hot, before))

    def right(l: Column) -> Column:  # the edit is to the left; places count from the end
        return F.xxhash64(F.lit("right"), "gram", l, F.col("l") - F.col("at"), F.when(hot, after))

    own, one_less = F.col("l"), F.col("l") - 1
    a = rare.select("word", "n", F.explode(F.array(left(own), right(own))).alias("key"))
    keys = ((left(own), False), (F.when(hot, right(own)), False),  # of equal length both would bring the same words
            (left(one_less), True), (right(one_less), True))
    b = rare.select("word", "n", F.explode(F.array(*(F.struct(k.alias("key"), F.lit(longer).alias("longer")) for k, longer in keys))).alias("k"))
    b = b.select("word", "n", "k.*").filter("key is not null")
    met = a.alias("a").join(b.alias("b"), F.expr("a.key = b.key AND (b.longer OR a.word < b.word)"))
    near = met.filter(F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    return near.select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n")).distinct()


def grouped(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the near words of each word, and the spelling it stands for.

    A form is ``times`` as frequent as its word, so a chain of forms is no longer than the logarithm of the
    largest count, and each round doubles the steps that every word has taken.
    """
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionAll(
        pairs.select(F.col("b"), F.col("a"), F.col("a_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    enough = -F.col("best.n") >= times * F.col("n")
    rows = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")), "forms")
    steps = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    most = rows.agg(F.max("n")).first()[0] or 1
    longest, taken = int(math.log(most, times)) + 1, 1
    while taken < longest:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        steps = stage(steps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
        taken *= 2
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
             slip: int = SLIP) -> DataFrame:
    """The words of all texts with their spelling variants.

    Returns per word: the near word it is a variant of (``form``; the most frequent one, of equals the least in
    code-point order, null unless ``times`` as frequent), the last form of the chain (``root``; the word itself
    without a form), its occurrences, the number of words one edit away, and the form's occurrences.  An empty
    table, null and empty texts give no words; repeated rows count again; other columns are not looked at.
    """
    words = stage(vocabulary(docs, least_length, least_count, slip), "vocabulary")
    return grouped(words, near_pairs(words, dictionary(words), least_length), times)
