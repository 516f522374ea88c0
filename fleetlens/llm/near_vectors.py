"""Near-duplicate vectors by cross-polytope hashing after fast pseudo-random rotations.

A rotation is three rounds of random signs and a fast Hadamard transform; the hash is the nearest of the
2 d signed axes. A table joins ``width`` such hashes to a bucket; each vector is stored in its own bucket
and also looks into the buckets of its next-best axes (multiprobe). The width follows the number of
vectors, so a bucket of unrelated vectors stays small, and the number of tables follows the width. Every
candidate pair is verified by its cosine in double precision.

Equal vectors form a class and travel once. Pairs are found and counted inside a bucket, in blocks of
bounded size; a pair that meets several times counts at its first meeting, which each task works out from
the hashes of the two vectors. So only one row per vector and bucket leaves a task, never a pair.

Nulls, ties and odd rows: a null, zero or non-finite vector, and one with a null label, links with
nothing and is its own component; vectors of different lengths do not link; a null vec_id is kept and
counts as a link of the others but never names a component (unless all are null); repeated rows are
links of each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.links import components
from fleetlens.llm.store import keep

COSINE = 0.98
PROBES = 3
BLOCK = 1024
FILL = 32


def plan_hash(n: int, dim: int) -> tuple[int, int]:
    """Axes per bucket and number of tables for n vectors."""
    width = max(1, math.ceil(math.log(max(n / FILL, 1.01)) / math.log(2 * dim)))
    return width, math.ceil(2.5 * 1.35**width)


def _hadamard(x: np.ndarray) -> np.ndarray:
    step = 1
    while step < x.shape[1]:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        step *= 2
    return x


def _rotated(x: np.ndarray, number: int) -> np.ndarray:
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng(1000 + number).choice([-1.0, 1.0], (3, size))
    for s in signs:
        y = _hadamard(y * s) / math.sqrt(size)
    return y


def buckets(x: np.ndarray, width: int, tables: int) -> np.ndarray:
    """n x tables x (1 + PROBES) bucket numbers; the first is the vector's own."""
    out = np.empty((len(x), tables, 1 + PROBES), np.uint64)
    rows = np.arange(len(x))
    for t in range(tables):
        axes, swaps, losses = [], [], []
        for w in range(width):
            y = _rotated(x, t * 64 + w)
            both = np.concatenate([y, -y], axis=1)
            top = np.argsort(-both, axis=1, kind="stable")[:, : PROBES + 1]
            axes.append(top[:, 0].astype(np.uint64))
            for p in range(1, top.shape[1]):
                swaps.append((w, top[:, p].astype(np.uint64)))
                losses.append(both[rows, top[:, 0]] - both[rows, top[:, p]])
        ranked = np.argsort(np.stack(losses, 1), axis=1, kind="stable")

        def number(choice: list[np.ndarray], t: int = t) -> np.ndarray:
            code = np.full(len(x), t + 1, np.uint64)
            for axis in choice:
                code = tx.mix(code * np.uint64(0x9E3779B97F4A7C15) + axis)
            return code

        out[:, t, 0] = number(axes)
        options = np.stack([number([s if w == v else axes[v] for v in range(width)]) for w, s in swaps], 1)
        for p in range(PROBES):
            out[:, t, 1 + p] = options[rows, ranked[:, min(p, ranked.shape[1] - 1)]]
    return out


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _hash(width: int, tables: int):
    def run(table: pa.Table) -> pa.Table:
        parts = []
        for at in range(0, len(table), 2048):
            own = table.slice(at, 2048)
            found = buckets(_vectors(own["vector"]), width, tables).reshape(len(own), -1)
            n = found.shape[1]
            keys, spaces = own["key"].to_numpy(), own["space"].to_numpy()
            codes = tx.mix(found.ravel() + tx.mix(np.repeat(spaces, n).view(np.uint64)))
            parts.append(
                pa.table(
                    {
                        "bucket": codes.view(np.int64),
                        "key": np.repeat(keys, n),
                        "stored": np.tile(np.arange(n) % (1 + PROBES) == 0, len(own)),
                    }
                )
            )
        return pa.concat_tables(parts)

    return run


def _pairs(cosine: float, width: int, tables: int):
    def run(table: pa.Table) -> pa.Table:
        none = pa.table({"key": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        order = np.argsort(table["key"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        keys, sizes = table["key"].to_numpy(), table["size"].to_numpy()
        stored = table["stored"].to_numpy(zero_copy_only=False)
        half = table["half"].to_numpy()
        x = _vectors(table["vector"])
        norms = np.sqrt((x * x).sum(1))
        near = (x @ x.T) / np.outer(norms, norms) >= cosine
        near &= (stored[:, None] | stored[None, :]) & (keys[:, None] < keys[None, :])
        if table["lo"][0].as_py() != table["hi"][0].as_py():
            near &= half[:, None] != half[None, :]
        a, b = np.nonzero(near)
        if not len(a):
            return none
        involved, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        codes = buckets(x[involved], width, tables)
        space = np.uint64(np.int64(table["space"][0].as_py()).view(np.uint64))
        codes = tx.mix(codes + tx.mix(np.array([space]))[0])
        here = np.uint64(np.int64(table["bucket"][0].as_py()).view(np.uint64))
        i, j = place[: len(a)], place[len(a) :]
        first = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
        open_ = np.ones(len(a), bool)
        for t in range(tables):
            own_i, own_j = codes[i, t, 0], codes[j, t, 0]
            at_i = (codes[j, t] == own_i[:, None]).any(1)
            at_j = (codes[i, t] == own_j[:, None]).any(1)
            top = np.iinfo(np.uint64).max
            meet = np.minimum(np.where(at_i, own_i, top), np.where(at_j, own_j, top))
            now = open_ & (at_i | at_j)
            first[now] = meet[now]
            open_ &= ~now
        a, b = a[first == here], b[first == here]
        if not len(a):
            return none
        links = np.bincount(a, sizes[b], len(keys)) + np.bincount(b, sizes[a], len(keys))
        root = np.arange(len(keys))
        while True:  # smallest label along links
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        used = np.flatnonzero(links > 0)
        return pa.table({"key": keys[used], "links": links[used].astype(np.int64), "root": keys[root[used]]})

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    values = F.col("embedding").cast("array<double>")
    usable = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(values, lambda v: v != 0)
    )
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "embedding")).alias("key"),
        F.xxhash64("label", F.size("embedding")).alias("space"),
        F.col("embedding").alias("vector"),
    )
    classes = keep(
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.count("*").alias("size"), F.first("space").alias("space"), F.first("vector").alias("vector")),
        "classes",
    )
    found = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    width, tables = plan_hash(found.n, found.dim or 1)
    dealt = F.pmod(F.col("key"), F.lit(64))
    signed = classes.groupBy("space", dealt.alias("part")).applyInArrow(
        _hash(width, tables), "bucket long, key long, stored boolean"
    )
    signed = keep(signed.groupBy("bucket", "key").agg(F.max("stored").alias("stored")), "buckets")
    busy = signed.groupBy("bucket").agg(F.count("*").alias("members"), F.max("stored").alias("any"))
    busy = busy.where("members > 1 and any").select("bucket", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    members = (
        signed.join(busy, "bucket")
        .withColumn("half", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("lo", F.least("half", "other"))
        .withColumn("hi", F.greatest("half", "other"))
        .join(classes, "key")
        .select("bucket", "lo", "hi", "half", "key", "stored", "size", "space", "vector")
    )
    linked = keep(
        members.groupBy("bucket", "lo", "hi").applyInArrow(
            _pairs(cosine, width, tables), "key long, links long, root long"
        ),
        "links",
    )
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    own = (
        rows.select("vec_id", "key")
        .join(classes.select("key", "size"), "key", "left")
        .join(counts, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("vec_id", "key", "size", "links", F.coalesce("root", "key").alias("root"))
    )
    names = own.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("name"))
    return own.join(names, "root", "left").select(
        "vec_id",
        (F.coalesce(F.col("size") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("name", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("name", "vec_id")).alias("kept"),
    )
