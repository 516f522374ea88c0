"""Similarity join of documents by the Jaccard similarity of their word n-gram sets, with PartEnum.

Sets whose sizes lie in the same or a neighbouring band (bands grow by 1/threshold) are the only ones
that can link, and then differ in at most k elements, where k depends on the band alone. The element domain
is cut by hash in two levels (PartEnum): n1 first-level partitions, so many that two such sets differ in at
most k2 elements of one of them, each cut into n2 > k2 second-level ones; then n2 - k2 of the second level
agree, so one signature is made for each subset of that size. The plan of a band is the one whose signatures
cover the most elements within a bound on their number. A set has no signature for a subset without any of
its elements, as long as fewer first-level partitions hold such a subset than there are spare ones: then
enough others agree, so nothing is lost, while no signature is shared by everybody.

Documents with equal sets form a class. Each class is first compared with one other: of the smallest classes
of its shared signatures, the most frequent. What that links is joined into components; then each class is
compared with one smallest class of every other component that it shares a signature with (a star for each
signature, so pairs grow with the signatures and not with their square). Signatures that still hold several
components are searched pair by pair across components, in blocks of bounded size, and twice: first each component
is compared by the nearest pair that it has with any other, so pairs grow with the components; then what still lies
apart is compared whole. A lower bound on the difference (the distance of odd sketches, that is of the parities of
the elements in two to four cells for each element) throws out pairs that cannot link before their sets are made; all
other comparisons are exact.

Nulls, ties and odd rows: a null or blank text has an empty set and links with nothing; a row with a null doc_id
is compared like any other and takes the smallest doc_id of its component, null if there is none; repeated rows
are kept, the smallest doc_id names a component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.links import components
from fleetlens.llm.store import bound_batches, keep

SHINGLE, PERCENT = 3, 90
#: Cells of a set's sketch, a bit each: two to four for an element, within these limits, a power of two.
LEAST_CELLS, MOST_CELLS = 1024, 8192
#: Signatures that a set may have per band: for each element that two linked sets may differ in, and at least.
PER_ELEMENT, LEAST = 1.7, 16
#: Signatures, or pairs, that a task gathers before it hands them on, and members of a block of pairs.
FLUSH, BLOCK = 1 << 18, 1024
#: Rows of the blocks of one group of near copies that go to the same task.
SHARE = 1 << 12
#: Pairs whose sketches are compared at once.
CLOSE = 1 << 12


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; of a shorter text, its whole word sequence."""
    for _, counts, found in tx.words(column, tx.NON_BLANK):
        whole = np.zeros(0, np.uint64)
        if len(found) >= size:
            whole = found[: len(found) - size + 1].copy()
            for k in range(1, size):
                whole = tx.mix(whole * np.uint64(5) + found[k : len(found) - size + 1 + k])
        at = 0
        for n in counts:
            if n >= size:
                yield np.unique(whole[at : at + n - size + 1])
            elif n:
                one = found[at : at + 1].copy()
                for k in range(1, n):
                    one = tx.mix(one * np.uint64(5) + found[at + k : at + k + 1])
                yield tx.mix(one + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)
            at += n


def bands(percent: int, upto: int) -> np.ndarray:
    """Largest set size of each band; a set of ``upto`` lies in the last but one at most."""
    ends = [1]
    while ends[-1] <= upto:
        ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    ends.append((ends[-1] + 1) * 100 // percent)
    return np.array(ends)


class Plan(NamedTuple):
    """How a band cuts the domain: first and second level, spare first-level partitions, subsets, cuts."""

    first: int
    second: int
    spare: int
    subsets: np.ndarray
    cuts: np.ndarray


@functools.lru_cache(maxsize=512)
def plan(largest: int, percent: int) -> Plan:
    """The cut for sets of up to ``largest`` elements whose signatures cover the most elements."""
    differ = 2 * (100 - percent) * largest // (100 + percent)
    best = None
    for k2 in range(min(differ, 4) + 1):
        for n2 in range(k2 + 1, k2 + 6 if k2 else 2):
            n1 = differ // (k2 + 1) + 1
            spare = 0 if n1 == 1 else 1 + n1 // 16
            signs = (n1 + spare) * comb(n2, k2)
            cover = (n2 - k2) / ((n1 + spare) * n2)
            if signs <= max(LEAST, PER_ELEMENT * (differ + 1) + 4) or k2 == 0:
                best = max(best or (0,), (cover, -signs, n1 + spare, n2, k2, spare))
    _, _, n1, n2, k2, spare = best
    cells = n1 * n2
    cuts = np.array([(i << 64) // cells for i in range(cells)], np.uint64)
    return Plan(n1, n2, spare, np.array(list(combinations(range(n2), n2 - k2)), np.int64), cuts)


def signatures(shingles: np.ndarray, percent: int, ends: np.ndarray) -> np.ndarray:
    """PartEnum signatures of one set for its band and the next one."""
    if not len(shingles):
        return np.empty(0, np.uint64)
    band = int(np.searchsorted(ends, len(shingles)))
    mixed = tx.mix(shingles + np.uint64(0x51))
    out = []
    for b in (band, band + 1):
        cut = plan(int(ends[b]), percent)
        begins = np.searchsorted(shingles, cut.cuts)
        filled = np.diff(np.append(begins, len(shingles))) > 0
        content = np.zeros(len(begins), np.uint64)
        content[filled] = np.add.reduceat(mixed, begins[filled])
        content = tx.mix(content + np.uint64(0x9E37)).reshape(cut.first, cut.second)
        covers = filled.reshape(cut.first, cut.second)[:, cut.subsets].any(2)
        place = np.arange(cut.first * len(cut.subsets), dtype=np.uint64).reshape(cut.first, -1)
        signs = content[:, cut.subsets].sum(2, dtype=np.uint64)
        signs = tx.mix(signs + place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b) * np.uint64(0x79B97F4A7C15))
        bare = (~covers).any(1).sum()
        out.append(signs[covers] if bare <= cut.spare else signs.ravel())
    return np.concatenate(out)


def sketch(shingles: np.ndarray) -> bytes:
    """Odd sketch: whether an odd number of elements lie in each cell, which their trailing bits name, a bit a cell."""
    bits = min(max((2 * len(shingles)).bit_length(), LEAST_CELLS.bit_length() - 1), MOST_CELLS.bit_length() - 1)
    cell = (shingles & np.uint64((1 << bits) - 1)).astype(np.int64)
    odd = (np.bincount(cell, minlength=1 << bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def set_key(shingles: np.ndarray) -> np.uint64:
    return tx.mix(np.sum(tx.mix(shingles + np.uint64(0x7)), dtype=np.uint64)[None] + np.uint64(len(shingles)))[0]


SIGNED = pa.schema(
    [("bucket", pa.int64()), ("settled", pa.bool_()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("key", pa.int64())]
    + [("parts", pa.binary()), ("signs", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]
)
FOUND = "doc_id long, mark long, n long, key long, parts binary, sign long, rep long"


def _signed_rows(buckets: int, signs: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs (signature, set) by bucket. Of the sets that share a signature here only the smallest
    travels with it; all of them leave as settled rows, dealt out by chance, so that no signature,
    however frequent, gathers more than one row of each task."""
    order = np.lexsort((keys, signs))
    signs, keys = signs[order], keys[order]
    fresh = np.ones(len(signs), bool)
    fresh[1:] = (signs[1:] != signs[:-1]) | (keys[1:] != keys[:-1])
    signs, keys = signs[fresh], keys[fresh]
    lead = np.ones(len(signs), bool)
    lead[1:] = signs[1:] != signs[:-1]
    run = np.cumsum(lead) - 1
    shared = np.bincount(run)[run] > 1
    for settled, s, k, spread in (
        (False, signs[lead], keys[lead], signs[lead]),
        (True, signs[shared], keys[shared], tx.mix(signs[shared])),
    ):
        where = (spread % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(where, kind="stable")
        bounds = np.searchsorted(where[by], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(bounds))
        ends = np.append(bounds[full], bounds[-1]).astype(np.int32)
        yield pa.record_batch(
            [
                pa.array(full, pa.int64()),
                pa.array(np.full(len(full), settled)),
                *(pa.nulls(len(full), pa.int64()) for _ in range(4)),
                pa.nulls(len(full), pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(s[by].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(k[by].view(np.int64))),
            ],
            schema=SIGNED,
        )


def _sign(size: int, percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, signs, keys, held, at = bands(percent, 1 << 40), [], [], 0, 0
        for batch in batches:
            n, own, parts = [], [], []
            for shingles in shingle_sets(batch.column(2), size):
                key = set_key(shingles)
                n.append(len(shingles))
                own.append(key)
                parts.append(sketch(shingles))
                signs.append(signatures(shingles, percent, ends))
                keys.append(np.full(len(signs[-1]), key))
                held += len(signs[-1])
                if held >= FLUSH:
                    yield from _signed_rows(buckets, np.concatenate(signs), np.concatenate(keys))
                    signs, keys, held = [], [], 0
            own_keys = np.array(own, np.uint64).view(np.int64)
            # documents need no meeting, so equal texts and equal ids are dealt out by their place too
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            spread = tx.mix(tx.mix(ids) + np.arange(at, at + len(n), dtype=np.uint64))
            at += len(n)
            yield pa.record_batch(
                [
                    pa.array((spread % np.uint64(buckets)).astype(np.int64), pa.int64()),
                    pa.nulls(len(n), pa.bool_()),
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(own_keys, pa.int64()),
                    pa.array(parts, pa.binary()),
                    *(pa.nulls(len(n), pa.list_(pa.int64())) for _ in range(2)),
                ],
                schema=SIGNED,
            )
        if held:
            yield from _signed_rows(buckets, np.concatenate(signs), np.concatenate(keys))

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: its documents, and the signatures that more than one set has."""
    docs = table.filter(pa.compute.is_null(table["settled"]))
    parts = [docs.select(["doc_id", "mark", "n", "key", "parts"])]
    for settled in (False, True):
        rows = table.filter(pa.compute.equal(table["settled"], settled))
        for own in [rows] if not settled else [rows.slice(i, 1) for i in range(len(rows))]:
            if not len(own):
                continue
            signs = own["signs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            keys = own["keys"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            order = np.lexsort((keys, signs))
            signs, keys = signs[order], keys[order]
            lead = np.ones(len(signs), bool)
            lead[1:] = signs[1:] != signs[:-1]
            fresh = lead.copy()
            fresh[1:] |= keys[1:] != keys[:-1]
            signs, keys, lead = signs[fresh], keys[fresh], lead[fresh]
            run = np.cumsum(lead) - 1
            more = np.bincount(run)[run] > 1
            reps = keys[lead][run]
            parts.append(
                pa.table({"key": keys[more].view(np.int64), "sign": signs[more].view(np.int64), "rep": reps[more].view(np.int64)})
            )
    empty = pa.table({"sign": pa.array([], pa.int64()), "rep": pa.array([], pa.int64())})
    return pa.concat_tables([*parts, empty], promote_options="default").select(
        ["doc_id", "mark", "n", "key", "parts", "sign", "rep"]
    )


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            key, members = [], []
            for shingles in shingle_sets(batch.column(0), size):
                own = set_key(shingles)
                if own not in seen:  # rows of one text are here together
                    seen.add(own)
                    key.append(own)
                    members.append(shingles.tobytes())
            yield pa.record_batch(
                [pa.array(np.array(key, np.uint64).view(np.int64), pa.int64()), pa.array(members, pa.binary())],
                names=["key", "members"],
            )

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree: dict[int, int] = {}

            def top(node: int) -> int:
                while tree.setdefault(node, node) != node:
                    tree[node] = node = tree[tree[node]]
                return node

            out_a, out_b = [], []
            for i, j, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if top(i) == top(j):
                    continue  # this batch has linked them already
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    tree[top(i)] = top(j)
                    out_a.append(i)
                    out_b.append(j)
            yield pa.record_batch([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return run


def verified(pairs: DataFrame, info: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) of set keys, links that join the same keys as all whose sets link do, by exact
    comparison; links inside what a batch has joined already are left out. The sets are made again from
    one text of each key."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    needed = keep(info.join(wanted, "key", "left_semi").select("doc_id", "mark").distinct(), "needed", tidy=True)
    same = [F.col("of.mark") == F.col("needed.mark"), F.col("of.doc_id").eqNullSafe(F.col("needed.doc_id"))]
    texts = rows.alias("of").join(needed.alias("needed"), same, "left_semi").repartition("mark").select("text")
    sets = keep(texts.mapInArrow(_sets(size), "key long, members binary"), "sets", tidy=True)
    left = sets.select(F.col("key").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("members").alias("y"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return keep(both.mapInArrow(_similar(percent), "a long, b long"), "links", tidy=True)


def _folded(rows: list[bytes], width: int) -> np.ndarray:
    """The sketch of each set for ``width`` bytes of cells, as words of 64."""
    out = np.empty((len(rows), width // 8), np.uint64)
    sizes = np.array([len(r) for r in rows])
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        flat = np.frombuffer(b"".join(rows[i] for i in own), np.uint64)
        out[own] = np.bitwise_xor.reduce(flat.reshape(len(own), size // width, width // 8), axis=1)
    return out


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right).sum(1, dtype=np.int64)


def _distance(x: pa.Array, y: pa.Array) -> np.ndarray:
    """A lower bound on the number of elements that two sets do not share."""
    x, y = x.to_pylist(), y.to_pylist()
    widths = np.array([min(len(a), len(b)) for a, b in zip(x, y)], np.int64)
    out = np.empty(len(x), np.int64)
    for width in np.unique(widths):
        for own in np.array_split(np.flatnonzero(widths == width), max(1, (widths == width).sum() * width // FLUSH)):
            out[own] = _apart(_folded([x[i] for i in own], width), _folded([y[i] for i in own], width))
    return out


def _within(percent: int):
    """Pairs (a, b, n, sketch of either) that the bound lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            most = (100 - percent) * (na + nb) // (100 + percent)
            ok = _distance(batch.column(4), batch.column(5)) <= most
            yield pa.record_batch([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    return run


def _nearest(found: np.ndarray) -> np.ndarray:
    """Of the pairs (a, b, root of either, distance) the nearest of each component."""
    a, b, _, _, apart = both = np.concatenate([found, found[[0, 1, 3, 2, 4]]], axis=1)
    order = np.lexsort((b, a, apart, both[2]))
    lead = np.ones(len(order), bool)
    lead[1:] = both[2][order[1:]] != both[2][order[:-1]]
    return found[:, np.unique(order[lead] % found.shape[1])]


CLOSEST = "a long, b long, root_a long, root_b long, apart long"


def _close(percent: int, nearest: bool):
    """Pairs (as in CLOSEST) of one block that lie in different components and that the bound lets through, or of
    these the nearest of each component; rows come sorted by block, and all blocks of a batch are compared at once,
    neighbour by neighbour."""
    ends = bands(percent, 1 << 40)

    def batch_of(found: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x) for x in found], names=["a", "b", "root_a", "root_b", "apart"])

    def once(found: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate(found, axis=1)
        if nearest and every.shape[1]:
            return _nearest(every)
        order = np.lexsort(every[1::-1])
        fresh = np.ones(len(order), bool)
        fresh[1:] = (every[:2, order[1:]] != every[:2, order[:-1]]).any(0)
        return every[:, order[fresh]]

    def pairs(rows: pa.Table) -> Iterator[np.ndarray]:
        names = ("sign", "lo", "hi", "half", "key", "root", "n")
        columns = np.stack([rows[c].to_numpy() for c in names])
        sizes = rows["parts"].to_pylist()
        # the sets of a block are alike in size, so they are compared by the cells of the smallest
        change = (columns[:3, 1:] != columns[:3, :-1]).any(0)
        block = np.concatenate([[0], np.cumsum(change)])
        least = np.minimum.reduceat(np.array([len(p) for p in sizes]), np.flatnonzero(np.append(True, change)))[block]
        for width in np.unique(least):
            own = np.flatnonzero(least == width)
            sign, lo, hi, half, key, root, n = columns[:, own]
            parts = _folded([sizes[i] for i in own], int(width))
            band = np.searchsorted(ends, n)
            at = np.arange(len(key))
            for step in range(1, len(key)):
                at = at[at + step < len(key)]
                to = at + step
                same = (sign[at] == sign[to]) & (lo[at] == lo[to]) & (hi[at] == hi[to])
                at, to = at[same], to[same]
                if not len(at):
                    break
                most = (100 - percent) * (n[at] + n[to]) // (100 + percent)
                ok = (root[at] != root[to]) & (np.abs(band[at] - band[to]) <= 1) & (np.abs(n[at] - n[to]) <= most)
                ok &= (lo[at] == hi[at]) | (half[at] != half[to])
                i, j, most = at[ok], to[ok], most[ok]
                apart = np.concatenate(
                    [_apart(parts[i[c : c + CLOSE]], parts[j[c : c + CLOSE]]) for c in range(0, max(1, len(i)), CLOSE)]
                )
                near = apart <= most
                i, j, apart = i[near], j[near], apart[near]
                i, j = np.where(key[i] < key[j], [i, j], [j, i])
                yield np.stack([key[i], key[j], root[i], root[j], apart])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # near copies meet under many signatures: a task hands a pair on once, as far as it can hold them
        out, size = [], 0
        for found in blocks(batches):
            out.append(found)
            size += found.shape[1]
            if size >= FLUSH:
                out = [once(out)]
                size = out[0].shape[1]
                if size >= FLUSH // 2:
                    yield batch_of(out[0])
                    out, size = [], 0
        if size:
            yield batch_of(once(out))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            block = np.stack([held[c].to_numpy() for c in ("sign", "lo", "hi")])
            cuts = np.flatnonzero((block[:, 1:] != block[:, :-1]).any(0))
            if len(cuts):  # the last block may go on in the next batch
                yield from pairs(held.slice(0, cuts[-1] + 1))
                held = held.slice(cuts[-1] + 1)
        if held is not None and len(held):
            yield from pairs(held)

    return run


def contracted(roots: DataFrame | None, links: DataFrame | None) -> DataFrame | None:
    """(node, root) of the components of ``roots`` joined by ``links`` (a, b); only what the links touch is contracted
    again."""
    if links is None:
        return roots
    if roots is None:
        return keep(components(links), "roots", tidy=True)
    of = roots.withColumnRenamed("root", "to")
    joined = links.join(of.withColumnRenamed("node", "a"), "a", "left").select("b", F.coalesce("to", "a").alias("a"))
    joined = joined.join(of.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("to", "b").alias("b"))
    joined = keep(joined.where("a <> b").distinct(), "joined", tidy=True)
    if not joined.limit(1).count():
        return roots
    upper = keep(components(joined), "upper", tidy=True).withColumnRenamed("root", "top")
    lower = roots.union(upper.select("node", F.col("node"))).dropDuplicates(["node"])
    moved = lower.join(upper.withColumnRenamed("node", "root"), "root", "left")
    return keep(moved.select("node", F.coalesce("top", "root").alias("root")), "roots", tidy=True)


def _blocks(members: DataFrame, roots: DataFrame, info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``members`` (key, sign) the signatures that hold several components, and their classes in blocks of two
    halves of bounded size, sorted."""
    placed = members.join(roots.withColumnRenamed("node", "key"), "key", "left")
    placed = keep(placed.select("key", "sign", F.coalesce("root", "key").alias("root")), "placed", tidy=True)
    open_ = placed.groupBy("sign").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("key")).alias("print"),
    )
    # near copies share many signatures: of those with the same sets, one is searched
    open_ = open_.where("low < high").groupBy("low", "high", "members", "print").agg(F.min("sign").alias("sign"))
    open_ = open_.select("sign", "low", "members", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    open_ = keep(open_, "open", tidy=True)
    # signatures of the same near copies share tasks, where a pair is handed on once, but no task holds a large group
    held = open_.groupBy("low").agg(F.ceil(F.sum(F.col("members") * F.col("blocks")) / SHARE).alias("shares"))
    open_ = open_.join(held, "low").withColumn("share", F.pmod(F.xxhash64("sign"), F.col("shares")))
    block = ["sign", "lo", "hi"]
    blocks = (
        placed.join(open_.select("sign", "low", "blocks", "share"), "sign")
        .withColumn("half", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("lo", F.least("half", "other"))
        .withColumn("hi", F.greatest("half", "other"))
        .join(info, "key")
        .select(*block, "half", "key", "root", "n", "parts", "low", "share")
        .repartition("low", "share", "lo", "hi")
        .sortWithinPartitions(*block, "key")
    )
    return placed.join(open_, "sign", "left_semi").select("key", "sign"), blocks


def ngram_join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text"))
    signed = rows.mapInArrow(
        _sign(size, percent, buckets),
        "bucket long, settled boolean, doc_id long, mark long, n long, key long, parts binary, signs array<long>, "
        "keys array<long>",
    )
    found = keep(signed.groupBy("bucket").applyInArrow(_shared, FOUND), "signed", tidy=True)
    owners = found.where("sign is null").select("doc_id", "n", "key")
    shared = found.where("sign is not null").select("key", "sign", "rep")

    # one document of each class that shares a signature
    info = found.where("sign is null").join(shared.select("key").distinct(), "key", "left_semi")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "n", "parts")).alias("one")
    info = info.groupBy("key").agg(one).select("key", "one.doc_id", "one.mark", "one.n", "one.parts")
    info = keep(info, "info", tidy=True)

    sides = [info.select(*(F.col(c).alias(f"{c}_{x}") for c in ("key", "n", "parts"))) for x in "ab"]

    def linked(stars: DataFrame, name: str) -> DataFrame | None:
        """Links of the pairs (key, rep) that the bound lets through, or None if it lets none."""
        pairs = stars.join(sides[0], F.col("rep") == F.col("key_a")).join(sides[1], F.col("key") == F.col("key_b"))
        pairs = pairs.select("key_a", "key_b", "n_a", "n_b", "parts_a", "parts_b")
        pairs = keep(pairs.mapInArrow(_within(percent), "a long, b long"), name, tidy=True)
        return verified(pairs, info, rows, size, percent) if pairs.limit(1).count() else None

    # each class with the smallest class of most of its signatures
    votes = keep(shared.where("rep <> key").groupBy("key", "rep").agg(F.count("*").alias("votes")), "votes", tidy=True)
    best = F.max_by("rep", F.struct("votes", "rep")).alias("rep")
    roots = contracted(None, linked(votes.groupBy("key").agg(best), "first"))
    # then with one of every other component
    if roots is not None:
        of = roots.select(F.col("node").alias("key"), F.col("root").alias("own"))
        to = roots.select(F.col("node").alias("rep"), F.col("root").alias("other"))
        apart = votes.join(of, "key", "left").join(to, "rep", "left").withColumns(
            {"own": F.coalesce("own", "key"), "other": F.coalesce("other", "rep")}
        )
        stars = apart.where("own <> other").groupBy("key", "other").agg(best)
        roots = contracted(roots, linked(stars, "stars"))
    else:
        roots = shared.select(F.col("key").alias("node"), F.col("key").alias("root")).limit(0)

    # signatures that still hold several components: the nearest pair of each component, then all across components
    members = shared.select("key", "sign").distinct()
    for nearest in (True, False):
        members, blocks = _blocks(members, roots, info)
        close = blocks.mapInArrow(_close(percent, nearest), CLOSEST)
        if nearest:
            near = keep(close, "near", tidy=True)
            ends = [near.select(F.col(f"root_{x}").alias("root"), "apart", "a", "b") for x in "ab"]
            one = F.min(F.struct("apart", "a", "b")).alias("one")
            close = ends[0].union(ends[1]).groupBy("root").agg(one).select("one.a", "one.b")
        close = keep(close.select("a", "b").distinct(), "close", tidy=True)
        if not close.limit(1).count():
            break
        roots = contracted(roots, verified(close, info, rows, size, percent))

    final = roots.withColumnRenamed("node", "key")
    classes = owners.join(final, "key", "left").select("doc_id", "n", F.coalesce("root", "key").alias("root"))
    names = classes.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("name"))
    return classes.join(names, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"),
    )
