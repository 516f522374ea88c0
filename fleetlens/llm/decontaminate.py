"""Benchmark decontamination over a positional inverted index of the training tokens.

``build_index`` cuts the documents into blocks of bounded size and stores, for each block, one row per
term with the positions where it stands, and one header row with the documents and where each begins.
``find_phrases`` cuts every test item into windows, looks up the postings of their terms, and in each
block intersects the offset-adjusted position lists, from a window's rarest term to its most frequent.
All terms in place is an exact match; all terms within ``slop`` positions of their place, but not all
in place, is a proximity match.

Nulls, ties and odd rows: a null or blank text has no words and gives a row with zeros; a document row
that is repeated gives a row each; a null doc_id stays null; other columns are ignored; items without
words are ignored, and an item without an id is called by the empty string. Without documents the
result is empty, without items every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.store import keep

WINDOW = 13
#: Tokens after which a block is closed; a block exceeds it by its last document at most.
BLOCK_TOKENS = 1 << 22

INDEX_SCHEMA = "block long, term long, n long, positions array<int>, doc_ids array<long>"
MATCH_SCHEMA = (
    "block long, ordinal long, doc_id long, n_words long, n_hit long, n_near long, "
    "windows array<long>, starts array<int>"
)


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _block_rows(block: int, ids: list, counts: np.ndarray, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
    begins = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    yield pa.record_batch(
        [
            pa.array([block], pa.int64()),
            pa.array([None], pa.int64()),
            pa.array([len(ids)], pa.int64()),
            pa.array([begins], pa.list_(pa.int32())),
            pa.array([ids], pa.list_(pa.int64())),
        ],
        names=["block", "term", "n", "positions", "doc_ids"],
    )
    order = np.argsort(tokens, kind="stable").astype(np.int32)
    ranked = tokens[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.empty(0, int)
    ends = np.append(first, len(ranked))
    for lo in range(0, len(first), 20_000):
        hi = min(lo + 20_000, len(first))
        a, b = ends[lo], ends[hi]
        yield pa.record_batch(
            [
                pa.array(np.full(hi - lo, block), pa.int64()),
                pa.array(ranked[first[lo:hi]].view(np.int64)),
                pa.array(np.diff(ends[lo : hi + 1]), pa.int64()),
                _lists(order[a:b], ends[lo : hi + 1] - a, pa.int32()),
                pa.nulls(hi - lo, pa.list_(pa.int64())),
            ],
            names=["block", "term", "n", "positions", "doc_ids"],
        )


def _postings(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, closed = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        counts, tokens, size = [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, n, found in tx.words(batch.column(1), tx.WORD):
                ids += names[row : row + len(n)]
                counts.append(n)
                tokens.append(found)
                size += len(found)
                if size >= block_tokens:
                    yield from _block_rows(base + closed, ids, np.concatenate(counts), np.concatenate(tokens))
                    ids, counts, tokens, size, closed = [], [], [], 0, closed + 1
        if ids:
            yield from _block_rows(base + closed, ids, np.concatenate(counts), np.concatenate(tokens))

    return run


def build_index(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Positional postings of all whole texts, stored in the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return keep(rows.mapInArrow(_postings(block_tokens), INDEX_SCHEMA), "postings")


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, counts, found in tx.words(batch.column(1), tx.WORD):
                at = 0
                for i, n in enumerate(counts):
                    own, at = found[at : at + n].view(np.int64), at + n
                    if not n:
                        continue
                    size = min(length, int(n))
                    view = np.lib.stride_tricks.sliding_window_view(own, size)
                    for lo in range(0, len(view), 5000):
                        part = view[lo : lo + 5000]
                        bounds = np.arange(len(part) + 1) * size
                        yield pa.record_batch(
                            [pa.array([ids[row + i]] * len(part), pa.string()), _lists(part.ravel(), bounds, pa.int64())],
                            names=["item", "terms"],
                        )

    return run


def item_windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Windows of the test items: (item, window, terms); equal windows have one number."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    return rows.mapInArrow(_windows(length), "item string, terms array<long>").withColumn(
        "window", F.xxhash64("terms")
    )


def _match(slop: int):
    """Phrase search in one block: left its header and postings, right the windows to look for."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        terms = left["term"].to_pylist()
        lists = left["positions"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        bounds = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        place = {t: i for i, t in enumerate(terms)}
        head = place.pop(None, None)
        if head is None:
            return pa.Table.from_arrays([pa.array([], f.type) for f in OUT], schema=OUT)
        begins = values[bounds[head] : bounds[head + 1]]
        ids = left["doc_ids"][head].as_py()
        total = int(begins[-1])
        edges = np.zeros(total + 1, np.int32)
        near_starts, hit_window, hit_start = [], [], []
        for window, plan in zip(right["window"].to_pylist(), right["plan"].to_pylist()):
            size = len(plan)
            starts, exact = None, None
            for step in plan:  # from the rarest term on
                at = place.get(step["term"])
                if at is None:
                    starts = None
                    break
                own = values[bounds[at] : bounds[at + 1]]
                if starts is None:
                    starts = own.astype(np.int64) - step["offset"]
                    exact = np.ones(len(starts), bool)
                    continue
                want = starts + step["offset"]
                after = np.searchsorted(own, want)
                right_gap = np.where(after < len(own), own[np.minimum(after, len(own) - 1)] - want, slop + 1)
                fits = right_gap == 0
                if slop:
                    left_gap = np.where(after > 0, want - own[np.maximum(after - 1, 0)], slop + 1)
                    close = np.minimum(right_gap, left_gap) <= slop
                    starts, exact = starts[close], (exact & fits)[close]
                else:
                    starts, exact = starts[fits], exact[fits]
                if not len(starts):
                    break
            if starts is None or not len(starts):
                continue
            doc = np.searchsorted(begins, starts, side="right") - 1
            inside = (starts >= 0) & (starts + size <= begins[np.minimum(doc + 1, len(begins) - 1)])
            starts, exact = starts[inside], exact[inside]
            near_starts.append(starts[~exact])
            starts = starts[exact]
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + size, -1)
            hit_window.append(np.full(len(starts), window))
            hit_start.append(starts)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
        near = np.sort(np.concatenate(near_starts)) if near_starts else np.empty(0, np.int64)
        windows = np.concatenate(hit_window) if hit_window else np.empty(0, np.int64)
        starts = np.concatenate(hit_start) if hit_start else np.empty(0, np.int64)
        order = np.argsort(starts, kind="stable")
        windows, starts = windows[order], starts[order]
        cut = np.searchsorted(starts, begins).astype(np.int32)
        # a document without words shares its place with the next one
        cut[:-1][np.diff(begins) == 0] = cut[1:][np.diff(begins) == 0]
        doc_of = np.repeat(begins[:-1], np.diff(cut)) if len(starts) else np.empty(0, np.int64)
        return pa.Table.from_arrays(
            [
                pa.array(np.full(len(ids), left["block"][0].as_py()), pa.int64()),
                pa.array(np.arange(len(ids)), pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(np.diff(begins), pa.int64()),
                pa.array(np.diff(covered[begins]), pa.int64()),
                pa.array(np.diff(np.searchsorted(near, begins)), pa.int64()),
                _lists(windows, cut, pa.int64()),
                _lists((starts - doc_of).astype(np.int32), cut, pa.int32()),
            ],
            schema=OUT,
        )

    return run


OUT = pa.schema(
    [("block", pa.int64()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64())]
    + [("n_hit", pa.int64()), ("n_near", pa.int64())]
    + [("windows", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32()))]
)


def find_phrases(index: DataFrame, windows: DataFrame, slop: int = 2) -> DataFrame:
    """One row per indexed document: its words, those inside an exact match, the number of proximity
    matches, and the windows found with the place where each begins."""
    once = windows.select("window", "terms").dropDuplicates(["window"])
    steps = once.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    vocabulary = keep(steps.select("term").distinct(), "test_terms")
    postings = index.join(vocabulary, "term", "left_semi")
    counts = postings.groupBy("term").agg(F.sum("n").alias("total"))
    # windows with a term that no document has are gone; the others list their terms by rarity
    plans = keep(
        steps.join(counts, "term")
        .groupBy("window", "size")
        .agg(F.array_sort(F.collect_list(F.struct("total", "offset", "term"))).alias("plan"))
        .where(F.size("plan") == F.col("size"))
        .select("window", "plan", F.col("plan")[0]["term"].alias("term")),
        "plans",
    )
    wanted = index.select("block", "term").join(plans, "term").select(F.col("block").alias("within"), "window", "plan")
    held = postings.unionByName(index.where("term is null")).select("block", "term", "positions", "doc_ids")
    return held.groupBy("block").cogroup(wanted.groupBy("within")).applyInArrow(_match(slop), MATCH_SCHEMA)


def decontaminate(docs: DataFrame, items: DataFrame, length: int = WINDOW, slop: int = 2) -> DataFrame:
    """Per document: n_words, n_hit, n_near, the items found (sorted as strings) and the decision.

    A document is contaminated when a twentieth of its words or more stand inside exact matches.
    """
    windows = keep(item_windows(items, length), "windows")
    found = find_phrases(build_index(docs), windows, slop)
    names = windows.select("window", "item").distinct()
    key = ["block", "ordinal"]
    return (
        found.withColumn("window", F.explode_outer(F.array_distinct("windows")))
        .drop("windows", "starts")
        .join(names, "window", "left")
        .groupBy(*key)
        .agg(
            *(F.first(c).alias(c) for c in ("doc_id", "n_words", "n_hit", "n_near")),
            F.array_sort(F.collect_set("item")).alias("items"),
        )
        .drop(*key)
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )
