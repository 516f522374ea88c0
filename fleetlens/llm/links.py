"""Connected components of links: a forest of each task's links, then alternating star contractions on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.store import keep

#: Links of a task when forests are joined, and nodes that a task holds before it hands its forest on.
LINKS, HELD = 1 << 16, 1 << 18
PAIR = "u long, v long"


def _forest(roots: bool):
    """(u, v) for each node u of the links (u, v) and the smallest node, v, of its component among them; a node that
    is its own v only with ``roots``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: dict[int, int] = {}

        def top(node: int) -> int:
            while tree.setdefault(node, node) != node:
                tree[node] = node = tree[tree[node]]
            return node

        def grown() -> pa.RecordBatch:
            found = [(node, least) for node in list(tree) if (least := top(node)) != node or roots]
            columns = [pa.array([pair[i] for pair in found], pa.int64()) for i in range(2)]
            return pa.record_batch(columns, names=["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = top(u), top(v)
                tree[max(u, v)] = min(u, v)
            if len(tree) >= HELD and not roots:
                yield grown()
                tree.clear()
        yield grown()

    return run


def _stars(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) after alternating star contractions: v is the smallest node that u reaches.

    Each round links the larger neighbours of a node, then the smaller ones, to the smallest of them;
    it stops when a round changes nothing. Rounds are cut by a table in the shared folder, and their shuffle
    files go with them. All grouping is a minimum, so a node with very many links is aggregated before it is
    shuffled.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = keep(pairs.distinct(), "pairs", tidy=True)
    seen = mark(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(below, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        pairs = keep(small, "pairs", tidy=True)
        now = mark(pairs)
        if now == seen:
            return pairs
        seen = now


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node reachable from it.

    Each task first leaves only a forest of its own links. The forests are joined in as many tasks as their
    links need, ``LINKS`` each: few links are done by then, in one task and without a shuffle; more than that
    are contracted by all tasks, round by round.
    """
    pairs = links.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    pairs = keep(pairs.where("u <> v").mapInArrow(_forest(False), PAIR), "forests", tidy=True)
    tasks = -(-pairs.count() // LINKS)
    if tasks <= 1:
        joined = keep(pairs.coalesce(1).mapInArrow(_forest(True), PAIR), "joined")
        return joined.select(F.col("u").alias("node"), F.col("v").alias("root"))
    pairs = _stars(pairs.coalesce(tasks).mapInArrow(_forest(False), PAIR))
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
