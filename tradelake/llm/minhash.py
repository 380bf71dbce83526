"""Near-duplicate groups by ProbMinHash, banding and verification.

A text is the weighted set of its shingles of five words, each weighing as often as it
occurs.  Each shingle runs a Poisson process: arrivals at a rate equal to its weight, each
at a random slot, both drawn from the shingle's own hash.  A slot keeps the shingle that
arrives first.  Two texts agree in a slot with their probability Jaccard similarity.  A
process ends once its next arrival is later than all slots of its text are filled, so the
work is a few arrivals per slot and one per shingle, not slots times shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm.names import unused
from tradelake.llm.ship import ship
from tradelake.session import stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
SALTS = 3
PAYS = 8  # rounds of pairs go on while more than one pair in so many is a link
FEW = 16  # a bucket of so many texts is settled by its pairs
PART, PART_BYTES = 2048, 8 << 20  # texts, and their bytes, of one part of a larger bucket
COLUMNS = 4096
U64 = np.uint64


class Shingles:
    """Distinct shingles of each text of a column with their counts, row by row and by hash.

    A text of fewer words, but not none, is one shingle.
    """

    def __init__(self, column: pa.Array, k: int = SHINGLE):
        words = bt.Words(column)
        self.rows = len(words.first) - 1
        h = words.hashes()
        at, hashes = words.windows(k, h)
        doc = words.doc[at]
        counts = np.diff(words.first)
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            extra = np.array([self._whole(h[words.first[i]:words.first[i + 1]]) for i in short], U64)
            doc, hashes = np.concatenate((doc, short)), np.concatenate((hashes, extra))
        order = np.lexsort((hashes, doc))
        doc, hashes = doc[order], hashes[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        head = np.flatnonzero(new)
        self.doc, self.hash = doc[head], hashes[head]
        self.count = np.diff(np.append(head, len(doc)))
        self.first = np.searchsorted(self.doc, np.arange(self.rows + 1))

    @staticmethod
    def _whole(h: np.ndarray) -> int:
        out = len(h)
        for x in h.tolist():
            out = (out * bt.BASE + x) & bt.MASK64
        return int(bt.mix(np.array([out], U64))[0])


def signatures(s: Shingles, slots: int) -> np.ndarray:
    """For each row and slot the hash of the shingle that arrives first; 0 in rows without shingles."""
    best = np.full(s.rows * slots, np.iinfo(np.uint64).max, U64)  # arrival time (32 bits) and shingle (32 bits)
    index = np.arange(len(s.hash))
    time = np.zeros(len(s.hash))
    state = s.hash.copy()
    while len(index):
        state = bt.mix(state + U64(0x9E3779B97F4A7C15))
        uniform = ((state >> U64(11)).astype(np.float64) + 0.5) / (1 << 53)
        time = time - np.log(uniform) / s.count[index]
        slot = (bt.mix(state ^ U64(bt.BASE_2)) >> U64(32)) * U64(slots) >> U64(32)
        where = s.doc[index] * slots + slot.astype(np.int64)
        # times of a text of n shingles shrink as 1 / n: a float keeps their order at any size
        code = time.astype(np.float32).view(np.uint32).astype(U64) << U64(32) | (s.hash[index] >> U64(32))
        np.minimum.at(best, where, code)
        last = best.reshape(s.rows, slots).max(axis=1) >> U64(32)
        stop = np.where(last == U64(0xFFFFFFFF), np.float64(np.inf), last.astype(np.uint32).view(np.float32).astype(np.float64))
        on = time <= stop[s.doc[index]]
        index, time, state = index[on], time[on], state[on]
    best = best.reshape(s.rows, slots) & U64(0xFFFFFFFF)
    best[np.diff(s.first) == 0] = 0
    return best


def similarity(a: Shingles, b: Shingles) -> np.ndarray:
    """Probability Jaccard of the rows of a and b, pair by pair, exactly.

    The sum over common shingles of 1 / sum over all shingles e of max(x_e / x_d, y_e / y_d).  With
    the shingles ordered by x / y the inner sum is a sum of y up to d and one of x after it.
    """
    out = np.zeros(a.rows)
    for r in range(a.rows):
        ha, hb = a.hash[a.first[r]:a.first[r + 1]], b.hash[b.first[r]:b.first[r + 1]]
        xa, xb = a.count[a.first[r]:a.first[r + 1]], b.count[b.first[r]:b.first[r + 1]]
        _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
        if not len(ia):
            continue
        x, y = xa[ia].astype(float), xb[ib].astype(float)
        only_x, only_y = xa.sum() - x.sum(), xb.sum() - y.sum()
        order = np.argsort(x / y, kind="stable")
        x, y = x[order], y[order]
        below = np.cumsum(y)  # e up to d: y_e / y_d is the larger ratio
        above = x.sum() - np.cumsum(x)
        out[r] = np.sum(1 / ((below + only_y) / y + (above + only_x) / x))
    return out


def sketch(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, band, value) for each text that has shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            batch = batch.take(pa.array(np.unique(batch.column(0).to_numpy(), return_index=True)[1]))  # copies once
            s = Shingles(batch.column(1))
            some = np.flatnonzero(np.diff(s.first) > 0)
            sig = signatures(s, bands * rows)[some].reshape(len(some), bands, rows)
            value = np.zeros((len(some), bands), U64)
            for i in range(rows):
                value = bt.mix(value * U64(bt.BASE) + sig[:, :, i])
            keys = batch.column(0).take(pa.array(np.repeat(some, bands)))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.tile(np.arange(bands, dtype=np.int32), len(some))), pa.array(value.ravel().view(np.int64))],
                ["key", "band", "value"])
    return texts.mapInArrow(run, "key long, band int, value long")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of (a, b), the pairs whose texts are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            close = similarity(Shingles(batch.column(2)), Shingles(batch.column(3))) >= threshold - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(close)) for i in (0, 1)], ["a", "b"])
    first = texts.select(F.col("key").alias("a"), F.col("text").alias("other"))
    second = texts.select(F.col("key").alias("b"), "text")
    joined = pairs.join(second, "b").join(first, "a")
    return joined.select("a", "b", "text", "other").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(key, group) of all keys in ``links`` (a, b): the least key that links reach.

    Each round moves every larger neighbour of a key to its least neighbour, then every smaller one
    likewise, so chains halve; a round's links are written to the shared folder before the next reads them.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).filter("a > b")
        edges = stage(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    groups = edges.groupBy("a").agg(F.min("b").alias("g")).select(F.col("a").alias("key"), F.col("g").alias("group"))
    return groups.unionAll(groups.select(F.col("group").alias("key"), "group").distinct())


def joined_groups(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """``groups`` (key, group) after some more links: only the groups that these touch are worked on."""
    if groups is None:
        return stage(components(links), "groups")
    name = [groups.select(F.col("key").alias(c), F.col("group").alias(f"group_{c}")) for c in "ab"]
    named = links.join(name[0], "a", "left").join(name[1], "b", "left").select(
        F.coalesce("group_a", "a").alias("a"), F.coalesce("group_b", "b").alias("b"))
    moved = stage(components(named), "moved").select(F.col("key").alias("group"), F.col("group").alias("to"))
    old = groups.join(moved, "group", "left").select("key", F.coalesce("to", "group").alias("group"))
    # keys that had no group before: those the new links name themselves
    fresh = moved.join(groups.select("group").distinct(), "group", "left_anti").select(F.col("group").alias("key"), F.col("to").alias("group"))
    return stage(old.unionAll(fresh), "groups")


def candidates(labelled: DataFrame, salt: int) -> DataFrame:
    """Pairs (a, b), a < b, of keys in one bucket that do not bear one label yet.

    Each label is stood for by one of its keys, another one in each round, and a bucket's labels are
    paired with its most central key and with their neighbour in an order by hash: two pairs a
    label.  A bucket with very many labels is ordered in parts, so that no task sorts it whole.
    """
    pick = F.struct(F.xxhash64("key", F.lit(salt)).alias("order"), "key", "central")
    heads = labelled.groupBy("band", "value", "label").agg(F.min(pick).alias("head")).select("band", "value", "head.*")
    hub = F.max(F.struct("central", "key")).alias("hub")
    buckets = heads.groupBy("band", "value").agg(hub, F.count("*").alias("n")).filter("n > 1")
    shared = heads.join(buckets, ["band", "value"])
    part = F.pmod("order", F.ceil(F.col("n") / 4096))
    before = F.lag("key").over(Window.partitionBy("band", "value", part).orderBy("order"))
    star = shared.filter("key != hub.key").select(F.col("hub.key").alias("other"), "key")
    chain = shared.select(before.alias("other"), "key").filter("other is not null")
    return star.unionAll(chain).select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()


def _mixed(values: DataFrame, groups: DataFrame) -> DataFrame:
    """``values`` with the labels that keys bear now, as far as a bucket has several: groups only grow, so the
    others are done for good."""
    label = values.select("key", "band", "value", "central").join(groups, "key", "left")
    label = label.withColumn("label", F.coalesce("group", "key")).drop("group")
    mixed = label.groupBy("band", "value").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most")
    return label.join(mixed.select("band", "value"), ["band", "value"], "left_semi")


def bounds(a: Shingles, b: Shingles) -> np.ndarray:
    """For each row of a and each of b a similarity that theirs does not exceed.

    With p and q the weight of the common shingles in either text, weights adding up to 1, it is
    1 / (1 / p + 1 / q - 1): each common shingle d adds to the similarity at most
    1 / (1 / p_d + (1 - q) / q_d), which is concave in (p_d, q_d).  It is the similarity itself if no
    shingle occurs twice in its text.
    """
    p, q = (np.zeros((a.rows, b.rows), np.float32) for _ in "pq")
    common = np.intersect1d(a.hash, b.hash)
    for at in range(0, len(common), COLUMNS):
        some = common[at:at + COLUMNS]
        (has_a, in_a), (has_b, in_b) = (_dense(s, some) for s in (a, b))
        p += in_a @ has_b.T
        q += has_a @ in_b.T
    with np.errstate(divide="ignore"):
        return 1 / (1 / p + 1 / q - 1)


def _dense(s: Shingles, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by the ascending hashes ``some``: 1 for a shingle that the row has, and its share of the row's weight."""
    at = np.minimum(np.searchsorted(some, s.hash), len(some) - 1)
    here = some[at] == s.hash
    total = np.bincount(s.doc, weights=s.count, minlength=s.rows)
    has, share = (np.zeros((s.rows, len(some)), np.float32) for _ in "hs")
    has[s.doc[here], at[here]] = 1
    share[s.doc[here], at[here]] = s.count[here] / total[s.doc[here]]
    return has, share


def _taken(s: Shingles, rows: np.ndarray) -> Shingles:
    """Some rows of s, in the order given."""
    out = object.__new__(Shingles)
    n = np.diff(s.first)[rows]
    out.rows, out.first = len(rows), np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(s.first[rows] - out.first[:-1], n) + np.arange(out.first[-1])
    out.doc, out.hash, out.count = np.repeat(np.arange(len(rows)), n), s.hash[at], s.count[at]
    return out


def _links(table: pa.Table, threshold: float) -> pa.Table:
    """Links (a, b) between the texts of the two sides of a pair of parts, or of one part met with itself, as
    many as it takes to join what is similar: texts that bear one label already are not compared."""
    _, at = np.unique(table.column("key").to_numpy(), return_index=True)
    twice = len(at) < table.num_rows  # a part met with itself has its rows on both sides
    side = table.column("side").to_numpy()
    if twice:
        table, side = table.take(pa.array(at)), None
    key = table.column("key").to_numpy()
    names, label = np.unique(table.column("label").to_numpy(), return_inverse=True)
    s = Shingles(table.column("text").combine_chunks())
    left, right = (np.arange(len(key)),) * 2 if twice else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    bound = bounds(_taken(s, left), _taken(s, right))
    i, j = np.nonzero((bound >= threshold - 1e-4) & (label[left][:, None] != label[right][None, :]))  # bounds are 32-bit floats
    order = np.argsort(-bound[i, j], kind="stable")
    i, j = left[i[order]], right[j[order]]
    if twice:
        i, j = i[i < j], j[i < j]
    head = np.arange(len(names))
    found = []
    while len(i):
        # the most similar pairs first; then those that these have joined need no look
        close = similarity(_taken(s, i[:256]), _taken(s, j[:256])) >= threshold - 1e-9
        for x, y in zip(i[:256][close].tolist(), j[:256][close].tolist()):
            x_head, y_head = head[label[x]], head[label[y]]
            if x_head != y_head:
                head[head == x_head] = y_head
                found.append((min(key[x], key[y]), max(key[x], key[y])))
        i, j = i[256:], j[256:]
        apart = head[label[i]] != head[label[j]]
        i, j = i[apart], j[apart]
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def open_buckets(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs (a, b) of differing labels in buckets of a few texts, and the rows of the other buckets."""
    values = values.select("key", "band", "value", "label")
    sizes = values.groupBy("band", "value").agg(F.count("*").alias("n"))
    sized = values.join(sizes, ["band", "value"])
    small = sized.filter(F.col("n") <= FEW)
    own = small.groupBy("band", "value").agg(F.collect_list(F.struct("key", "label")).alias("own"))  # FEW at most
    each = own.select(F.explode("own").alias("x"), "own").select("x", F.explode("own").alias("y"))
    pairs = each.filter("x.key < y.key and x.label <> y.label").select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    return pairs, sized.filter(F.col("n") > FEW).drop("n")


def settled(values: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between all texts of one bucket that bear differing labels, none left out.

    A bucket is dealt into parts by a hash, and each two parts meet in a task of their own, so that the
    work for a large bucket is spread.  A label with more texts than a part holds has parts to itself, which
    need not meet each other.
    """
    bytes_ = texts.select("key", F.octet_length("text").cast("long").alias("bytes"))
    sized = stage(values.join(bytes_, "key"), "open")
    of_part = F.ceil(F.greatest(F.col("n") / PART, F.col("bytes") / PART_BYTES))
    by_label = sized.groupBy("band", "value", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    by_label = by_label.select("*", of_part.alias("own_parts"))
    rest = by_label.filter("own_parts = 1").groupBy("band", "value").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    dealt = by_label.drop("n", "bytes").join(rest.select("band", "value", of_part.alias("parts")), ["band", "value"], "left")
    alone = F.col("own_parts") > 1
    part = F.struct(F.when(alone, F.col("label")).alias("alone"),
                    F.when(alone, F.pmod(F.xxhash64("key"), "own_parts")).otherwise(F.pmod(F.xxhash64("label"), "parts")).alias("number"))
    placed = stage(sized.join(dealt, ["band", "value", "label"]).select("key", "label", "band", "value", part.alias("part")), "parts")
    parts = placed.groupBy("band", "value", "part").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    x, y = (parts.select("band", "value", *(F.col(c).alias(f"{c}_{side}") for c in ("part", "least", "most"))) for side in (0, 1))
    one_label = F.expr("least_0 = most_0 and least_1 = most_1 and least_0 = least_1")
    meet = x.join(y, ["band", "value"]).filter(F.expr("part_0 <= part_1") & ~one_label)
    meet = meet.select("band", "value", F.xxhash64("band", "value", "part_0", "part_1").alias("meeting"), F.posexplode(F.array("part_0", "part_1")).alias("side", "part"))
    met = placed.withColumn("_alone", F.col("part.alone")).withColumn("_number", F.col("part.number")).drop("part").alias("p")
    meet = meet.withColumn("_alone", F.col("part.alone")).withColumn("_number", F.col("part.number")).drop("part").alias("m")
    same = ((F.col("p.band") == F.col("m.band")) & (F.col("p.value") == F.col("m.value"))
            & (F.col("p._number") == F.col("m._number")) & F.col("p._alone").eqNullSafe(F.col("m._alone")))
    rows = met.join(meet, same).select("meeting", "side", "key", "label").join(texts.select("key", "text"), "key")
    return rows.select("meeting", "side", "key", "label", "text").groupBy("meeting").applyInArrow(
        lambda table: _links(table, threshold), "a long, b long").distinct()


def link_texts(rows: DataFrame, threshold: float, bands: int, slots: int) -> DataFrame:
    """(key, group) of the texts (key, text) that have a similar one."""
    values = stage(sketch(rows, bands, slots), "bands")
    often = values.groupBy("band", "value").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
    values = stage(values.join(often.select("band", "value"), ["band", "value"], "left_semi").distinct(), "buckets")
    # a text that many others are copies of meets more of them than these meet each other
    sizes = values.groupBy("band", "value").agg(F.count("*").alias("n"))
    central = values.join(sizes, ["band", "value"]).groupBy("key").agg(F.sum("n").alias("central"))
    values = stage(values.join(central, "key"), "buckets")
    texts = stage(rows.join(central.select("key"), "key", "left_semi").dropDuplicates(["key"]), "texts")
    # first one pair for each text, with the most central text it meets; most find their group by that
    hubs = values.groupBy("band", "value").agg(F.max(F.struct("central", "key")).alias("hub"))
    best = values.join(hubs, ["band", "value"]).filter("key != hub.key").groupBy("key").agg(F.max("hub").alias("hub"))
    pairs = best.select(F.least("key", "hub.key").alias("a"), F.greatest("key", "hub.key").alias("b")).distinct()
    groups, tested, salt = None, None, 0
    while True:
        pairs = stage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        links = stage(verify(pairs, texts, threshold), "verified")
        tested = pairs if tested is None else tested.unionAll(pairs)
        groups = joined_groups(groups, links)
        values = stage(_mixed(values, groups), "buckets")
        rows.sparkSession._jvm.System.gc()  # Spark drops shuffle files of past rounds when the driver collects garbage
        if salt and links.count() * PAYS <= pairs.count():
            break
        pairs = reduce(DataFrame.unionAll, [candidates(values, s) for s in range(salt, salt + SALTS)]).distinct()
        salt += SALTS
    # rounds only save work: what they left open is settled here, pair by pair
    few, many = open_buckets(values)
    links = verify(few.join(tested, ["a", "b"], "left_anti"), texts, threshold)
    return joined_groups(groups, stage(links.unionAll(settled(many, texts, threshold)), "verified"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text")), F.xxhash64(text)


def _members(own: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """(key, copies, class_id, of_head) of each text; of_head: it is the text of the row that stands for its group."""
    groups = link_texts(own.select("key", "text"), threshold, bands, rows)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    named = own.groupBy("key").agg(F.min(order).alias("least"), F.count("*").alias("copies"))
    named = named.join(groups, "key", "left").withColumn("group", F.coalesce("group", "key"))
    heads = named.groupBy("group").agg(F.min("least").alias("head"))
    return named.join(heads, "group").select(
        "key", "copies", F.col("head.doc_id").alias("class_id"), (F.col("head.key") == F.col("key")).alias("of_head"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Groups documents by similar text.

    Returns per row of ``docs``: doc_id, class_id (the least doc_id of its group), copies (rows with
    this very text) and first (True for the row that a deduplication keeps: the one of the
    class_id; of rows that are equal in doc_id and text each is marked).  Texts are linked if the
    probability Jaccard similarity of their shingles of five words is at least ``threshold``; a
    text of fewer words is one shingle; groups are what links connect.  Equal texts are one
    group always, null and empty ones included; a text without words is like its equals only.  Rows
    without doc_id come after all others; a group of such rows only has a null class_id.  Other
    columns are not looked at.

    Texts are known by a 64-bit hash.  With 32 bands of 4 slots a pair at similarity 0.8 meets in no
    band once in 20 million; all pairs that meet in one are looked at, unless links join them already.
    """
    ship(docs.sparkSession)
    own, _ = _keyed(docs)
    return own.select("doc_id", "key").join(_members(own, threshold, bands, rows), "key").select(
        "doc_id", "class_id", "copies", (F.col("of_head") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("first"))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row of each group of ``near_duplicates``, whole: the one with the least doc_id; of rows that are equal in
    doc_id and text, any."""
    ship(docs.sparkSession)
    own, key = _keyed(docs)
    of_text, of_class = unused(docs, "_key", "_class")
    heads = _members(own, threshold, bands, rows).filter("of_head").select(F.col("key").alias(of_text), F.col("class_id").alias(of_class))
    kept = docs.withColumn(of_text, key).join(heads, of_text).filter(F.col("doc_id").cast("long").eqNullSafe(F.col(of_class)))
    return kept.dropDuplicates([of_text, "doc_id"]).select(*docs.columns)
