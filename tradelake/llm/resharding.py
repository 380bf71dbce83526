"""Resharding by minimum-cost flow.

Each old shard supplies its bytes, each new shard has a capacity.  A byte that stays in the
shard of its own number costs nothing, a byte that moves costs one: the cheapest flow says how
many bytes go from which shard to which with the fewest moved.  Documents are dealt into small
blocks, blocks are handed out to meet the flow, and only shards that gain or lose blocks are
written again.

The driver sees one row per block, whose number is a parameter; rows of documents stay in Spark.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.names import unused
from tradelake.session import scratch_path, stage

BLOCKS = 16384
ROW_IN_FILE = "row_in_file"
BROADCAST_FILES = 20_000  # a name takes some hundred bytes


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes to send from each old to each new shard, with the fewest bytes moved.

    Successive shortest paths on the graph source - old - new - sink; an edge from i to j costs 0 for
    i == j and 1 otherwise.  ``capacity`` has to hold all of ``supply``.
    """
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(n + m + 2)]  # edges [to, room, cost, place of the reverse edge]

    def edge(a: int, b: int, room: int, cost: int) -> None:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for i, bytes_ in enumerate(supply):
        edge(source, i, bytes_, 0)
        for j in range(m):
            edge(i, n + j, bytes_, int(i != j))
    for j, room in enumerate(capacity):
        edge(n + j, sink, room, 0)
    potential = [0] * len(graph)
    while True:
        far = [math.inf] * len(graph)
        via: list[tuple[int, int] | None] = [None] * len(graph)
        far[source] = 0
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k, (b, room, cost, _) in enumerate(graph[a]):
                if room and d + cost + potential[a] - potential[b] < far[b]:
                    far[b] = d + cost + potential[a] - potential[b]
                    via[b] = a, k
                    heapq.heappush(queue, (far[b], b))
        if via[sink] is None:
            break
        potential = [p + f if f < math.inf else p for p, f in zip(potential, far)]
        path, at = [], sink
        while at != source:
            a, k = via[at]
            path.append((a, k))
            at = a
        amount = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= amount
            graph[graph[a][k][0]][graph[a][k][3]][1] += amount
    return {(i, b - n): supply[i] - room for i in range(n) for b, room, cost, _ in graph[i]
            if n <= b < n + m and room < supply[i]}


def hand_out(blocks: dict[int, list[tuple[int, int]]], flow: dict[tuple[int, int], int], capacity: list[int]) -> dict[int, int]:
    """The new shard of each block; ``blocks`` has (bytes, block) by old shard.

    Large blocks first, each to the target with the most bytes still to come; then small blocks move from
    the shard most above its capacity to the one most below, as long as that brings the two closer.
    """
    shards = len(capacity)
    at: dict[int, int] = {}
    above = [-c for c in capacity]
    size = {b: s for own in blocks.values() for s, b in own}
    for i, own in sorted(blocks.items()):
        rest = {j: amount for (a, j), amount in flow.items() if a == i}
        for s, b in sorted(own, key=lambda x: (-x[0], x[1])):
            j = max(rest, key=lambda j: (rest[j], j == i, -j)) if rest else i % shards
            rest[j] = rest.get(j, 0) - s
            at[b] = j
            above[j] += s
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for b, j in at.items():
        heapq.heappush(held[j], (size[b], b))
    while True:
        full, empty = max(range(shards), key=lambda j: (above[j], -j)), min(range(shards), key=lambda j: (above[j], j))
        if above[full] <= 0 or not held[full] or held[full][0][0] >= above[full] - above[empty]:
            return at
        s, b = heapq.heappop(held[full])
        heapq.heappush(held[empty], (s, b))
        at[b] = empty
        above[full] -= s
        above[empty] += s


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def reshard(docs: DataFrame, shards: int, capacities: list[int] | None = None, blocks: int = BLOCKS,
            path: str | None = None, row: str | None = None) -> DataFrame:
    """Deals the rows of ``docs`` into new shards and writes the shards that change.

    ``docs`` has doc_id, text and old_shard (numbers from 0; a null counts as 0).  A row's size is
    its text's UTF-8 bytes plus one; a null text has none.  Without ``capacities`` the new
    shards get equal sizes, to within a block.  Rows are dealt into blocks by a hash of
    doc_id and text, about ``blocks`` in all, and whole blocks stay or move.  Rows that are equal in both are told
    apart by the column ``row``, which has to be the same whenever ``docs`` is read; without it, a table that has
    such rows is written once with numbered rows.

    Returns doc_id, text, old_shard, block, base (rows of the shard before this block) and shard of
    all rows: the written rows as read back from the files below ``path`` (default: the shared folder,
    a folder per shard), and the rows of shards that neither gain nor lose as they were.  ``slots``
    numbers them.  Other columns are dropped; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col("old_shard").cast("int"), F.lit(0)).alias("old_shard"),
                       (F.lit(0) if row is None else F.col(row)).cast("long").alias("row"))
    old = rows.agg(F.max("old_shard")).first()[0]
    if old is None:
        nothing = F.lit(None).cast("long")
        return rows.drop("row").select("*", nothing.alias("block"), nothing.alias("base"), F.lit(None).cast("int").alias("shard"))
    same = ["doc_id", F.md5(F.coalesce("text", F.lit(""))), F.col("text").isNull(), "old_shard"]
    if row is None and not rows.groupBy(*same).count().filter("count > 1").isEmpty():
        rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    per_shard = max(1, math.ceil(blocks / (old + 1)))
    block = F.col("old_shard").cast("long") * per_shard + F.pmod(F.xxhash64("doc_id", "text", "row"), F.lit(per_shard))
    rows = rows.withColumn("block", block).drop("row")
    found = rows.groupBy("block", "old_shard").agg(F.sum(size_of(F.col("text"))).alias("bytes"), F.count("*").alias("rows")).collect()
    own: dict[int, list[tuple[int, int]]] = {}
    for r in found:  # old shards whose number no new one has cost the same wherever they go: one supply for all of them
        own.setdefault(min(r.old_shard, shards), []).append((r.bytes, r.block))
    supply = [sum(s for s, _ in own.get(i, [])) for i in range(min(old, shards) + 1)]
    if capacities is None:
        share, more = divmod(sum(supply), shards)
        capacities = [share + (j < more) for j in range(shards)]
    at = hand_out(own, min_cost_flow(supply, capacities), capacities)
    before, base = [0] * shards, {}
    for r in sorted(found, key=lambda r: r.block):
        base[r.block] = before[at[r.block]]
        before[at[r.block]] += r.rows
    changed = {j for r in found for j in (at[r.block], r.old_shard) if at[r.block] != r.old_shard}
    plan = spark.createDataFrame([(b, j, base[b], j in changed) for b, j in at.items()],
                                 "block long, shard int, base long, changed boolean")
    dealt = rows.join(F.broadcast(plan), "block")  # a row per block
    path = path or scratch_path(spark, "shards")
    columns = ["doc_id", "text", "old_shard", "block", "base", "shard"]
    dealt.filter("changed").select(*columns).write.partitionBy("shard").parquet(path)
    written = spark.read.schema("doc_id long, text string, old_shard int, block long, base long, shard int").parquet(path)
    # old shards beyond the new ones count as changed too: what matters is whether a new shard with rows is left as it was
    return written if changed.issuperset(at.values()) else written.unionAll(dealt.filter("not changed").select(*columns))


def slots(dealt: DataFrame, *order: str) -> DataFrame:
    """``dealt`` with each row's place in its shard: gapless from 0, block by block, in ``order`` within a block.

    Blocks are small, so no task sorts a shard; take only the columns that are needed, they are shuffled.
    """
    within = F.row_number().over(Window.partitionBy("block").orderBy(*order))
    return dealt.withColumn("slot", F.col("base") + within - 1)


def file_shards(docs: DataFrame) -> DataFrame:
    """``docs`` with old_shard: the number, in the order of their names, of the file that holds the row; and, where
    the format tells it, with ``row_in_file``, which tells equal rows apart."""
    path = F.col("_metadata.file_path")
    names = sorted(r[0] for r in docs.select(path.alias("path")).distinct().collect())  # names of files only
    docs = docs.drop("old_shard", ROW_IN_FILE)
    if "row_index" in docs.select("_metadata").schema[0].dataType.names:
        docs = docs.withColumn(ROW_IN_FILE, F.col("_metadata.row_index"))
    if not names:
        return docs.withColumn("old_shard", F.lit(0))
    own = unused(docs, "path")[0]
    number = docs.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], f"{own} string, old_shard int")
    if len(names) <= BROADCAST_FILES:  # Spark cannot know the size; without this it moves the texts to meet the names
        number = F.broadcast(number)
    return docs.select("*", path.alias(own)).join(number, own).drop(own)
