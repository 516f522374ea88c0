"""Repeated strings of ``length`` bytes between documents, found by suffix arrays over shards.

Every string of ``length`` bytes contains 16-byte grams; the smallest hash among them is a function of the
string, so equal strings share it wherever they stand. Texts are packed into chunks and cut into pieces (runs of
positions with one such hash). The hashes of each chunk are counted first; only pieces whose hash also occurs
elsewhere are dealt, by their hash, to buckets, where all equal strings meet. There pieces that are byte for byte
the same are counted once, as they are in each chunk before the shuffle. The pieces that share a hash without
being the same form shards of at most ``SHARD`` bytes. Each shard gets a suffix array by Larsson-Sadakane
refinement (ranks of 8 bytes, doubled, only groups that are still tied), common prefixes by Kasai's rule, and
so its runs of equal strings with the smallest document of each; the sorted strings of the shards are merged by
binary search. Comparisons of strings are exact; hashes only bring them together.

A byte is removed if a string that covers it also starts in a document with a smaller doc_id. Defined results:
a null text is empty; a null doc_id counts as the largest number; rows with equal doc_ids are one document in
this, so none of them is removed for the other; a table without rows gives none; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.store import bound_batches, keep
from fleetlens.llm.text import utf8

LENGTH, GRAM = 50, 16
#: Bytes of text in a chunk (one longer text is a chunk by itself), of a shard, and of all texts for each bucket.
CHUNK, SHARD, BUCKET = 4 << 20, 4 << 20, 4 << 20
#: Bytes of a hash that are sent to be counted.
TAG = 5
LAST = np.iinfo(np.int64).max
#: Places whose grams are hashed at once.
BLOCK = 1 << 15
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
CHUNKS = "chunk long, ids array<long>, sizes array<long>, texts binary"
PIECES = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("pieces", pa.binary()), ("marks", pa.binary())])
_CODEC = "zstd"


def eight(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, the first byte lowest; zeros after the end."""
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    out = np.empty(len(raw) + 8, np.uint64)
    for k in range(8):
        part = padded[k : k + (len(padded) - k) // 8 * 8].view("<u8")
        own = out[k::8]
        own[:] = part[: len(own)]
    return out[: len(raw)]


# ---- suffix arrays


def suffix_array(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the suffixes that start there, and the rank of each place."""
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = eight(raw).byteswap()
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    alone = first & np.append(first[1:], True)
    slots, step = np.flatnonzero(~alone), 8
    while len(slots):
        place = order[slots]
        group, after = rank[place], place + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], n - after - 1)
        by = np.argsort(group * (2 * n + 16) + second + n, kind="stable")
        place, group, second = place[by], group[by], second[by]
        order[slots] = place
        first = np.ones(len(slots), bool)
        first[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        rank[place] = np.maximum.accumulate(np.where(first, slots, 0))
        slots = slots[~(first & np.append(first[1:], True))]
        step *= 2
    return order, rank


def common_prefixes(raw: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, ``cap`` at most.

    Kasai's rule (the next place of the text shares at least one byte less) along stretches of the text that
    are walked side by side; each step compares eight bytes or goes on by one place.
    """
    n = len(raw)
    if not n:
        return np.empty(0, np.int64)
    word = np.concatenate([eight(raw), np.zeros(1, np.uint64)])
    before = np.empty(n, np.int64)
    before[order[0]] = n
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    width = max(64, n // 4096)
    at = np.arange(0, n, width)
    stop = np.minimum(at + width, n)
    have = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        room = np.minimum(n - np.maximum(at, other), cap) - have
        differ = word[np.minimum(at + have, n)] ^ word[np.minimum(other + have, n)]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) >> 3)
        have += np.maximum(np.minimum(same, room), 0)
        done = (same < 8) | (room <= 8)
        shared[at[done]] = have[done]
        have = np.where(done, np.maximum(have - 1, 0), have)
        at = at + done
        if (at == stop).any():
            going = at < stop
            at, stop, have = at[going], stop[going], have[going]
    return shared[order]


class Shard:
    """Pieces one after the other with the document each belongs to: their equal strings, in order."""

    def __init__(self, pieces: list[bytes], ids: np.ndarray, length: int) -> None:
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(sizes)])
        order, _ = suffix_array(raw)
        run = np.cumsum(common_prefixes(raw, order, length) < length)
        piece = np.repeat(np.arange(len(pieces)), sizes)
        inside = np.arange(len(raw)) + length <= self.begins[piece + 1]  # strings don't cross pieces
        kept = inside[order]
        self.place, run = order[kept], run[kept]
        self.own = ids[piece[self.place]]
        lead = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.empty(0, np.int64)
        self.group = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(run))))
        self.least = np.minimum.reduceat(self.own, lead) if len(lead) else np.empty(0, np.int64)
        padded = np.concatenate([raw, np.zeros(length, np.uint8)])
        strings = np.lib.stride_tricks.sliding_window_view(padded, length)[self.place[lead]]
        self.strings = np.ascontiguousarray(strings).view(f"S{length}").ravel()

    def removed(self) -> list[tuple[int, int, int]]:
        """(piece, start, count) of runs of strings that a smaller document has."""
        hit = np.sort(self.place[self.least[self.group] < self.own])
        if not len(hit):
            return []
        piece = np.searchsorted(self.begins, hit, side="right") - 1
        lead = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (piece[1:] != piece[:-1])]))
        count = np.diff(np.append(lead, len(hit)))
        own = piece[lead]
        return list(zip(own.tolist(), (hit[lead] - self.begins[own]).tolist(), count.tolist()))


def _joined(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted tables of strings and their smallest documents as one: the larger is searched for the smaller's."""
    (large, least), (small, own) = (one, two) if len(one[0]) >= len(two[0]) else (two, one)
    if not len(small):
        return large, least
    at = np.searchsorted(large, small)
    known = large[np.minimum(at, len(large) - 1)] == small
    least = least.copy()
    least[at[known]] = np.minimum(least[at[known]], own[known])
    return np.insert(large, at[~known], small[~known]), np.insert(least, at[~known], own[~known])


def merge(shards: list[Shard]) -> None:
    """Give every shard the smallest document of each of its strings over all shards."""
    tables = [(s.strings, s.least) for s in shards]
    while len(tables) > 1:
        tables = [_joined(*tables[i : i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    if len(shards) > 1:
        for shard in shards:
            shard.least = tables[0][1][np.searchsorted(tables[0][0], shard.strings)]


# ---- chunks


def _packed(parts: list[np.ndarray | bytes]) -> bytes:
    plain = b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, _CODEC, asbytes=True)


def _plain(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), _CODEC, asbytes=True)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts as chunks, in the order of their ids."""
    first, seq, rows, held = TaskContext.get().partitionId() << 32, 0, [], 0

    def chunk() -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).sort_by("doc_id")  # nulls last
        raw, bounds = utf8(table["text"])
        ids, sizes = table["doc_id"].to_pylist(), np.diff(bounds).tolist()
        kind = pa.list_(pa.int64())
        return pa.record_batch(
            [pa.array([first + seq]), pa.array([ids], kind), pa.array([sizes], kind), pa.array([_packed([raw])], pa.binary())],
            names=["chunk", "ids", "sizes", "texts"],
        )

    for batch in batches:
        rows.append(batch)
        held += batch.nbytes
        if held >= CHUNK:
            yield chunk()
            seq, rows, held = seq + 1, [], 0
    if rows:
        yield chunk()


class Pieces:
    """The pieces of a chunk that are no copy of a smaller document's, and marks (doc, start, count) for the rest."""

    def __init__(self, ids: list[int | None], sizes: list[int], texts: bytes, length: int) -> None:
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        self.whole = _plain(texts)
        raw = np.frombuffer(self.whole, np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        self.marks: list[tuple[int, int, int]] = []
        seen, alive = {}, []
        for k, (s, e) in enumerate(zip(self.bounds.tolist(), self.bounds[1:].tolist())):
            if e - s < length:
                continue
            first = seen.setdefault(self.whole[s:e], k)
            if self.ids[first] < self.ids[k]:
                self.marks.append((k, 0, e - s - length + 1))
            else:
                alive.append(k)
        alive = np.array(alive, np.int64)
        begins, beyond = self.bounds[alive], self.bounds[alive + 1] - length + 1
        value = smallest_grams(raw, length) if len(alive) else np.empty(0, np.uint64)
        edge = np.zeros(len(value) + 1, bool)
        edge[1:-1] = value[1:] != value[:-1]
        edge[begins] = True
        edge[beyond] = True
        lead = np.flatnonzero(edge)
        doc = np.searchsorted(begins, lead, side="right") - 1
        inside = (doc >= 0) & (lead < beyond[doc]) if len(alive) else np.zeros(len(lead), bool)
        inside[-1:] &= lead[-1:] < len(value)
        self.count = np.diff(np.append(lead, len(value)))[inside]
        self.doc, self.place, self.value = alive[doc[inside]], lead[inside], value[lead[inside]]

    def drop_copies(self, length: int) -> np.ndarray:
        """Places in the lists of the pieces that no smaller document of the chunk has; the others are marked."""
        first, stay = {}, np.ones(len(self.doc), bool)
        ids = self.ids[self.doc].tolist()
        for k, (s, c) in enumerate(zip(self.place.tolist(), self.count.tolist())):
            if first.setdefault(self.whole[s : s + c + length - 1], ids[k]) < ids[k]:
                stay[k] = False
                d = int(self.doc[k])
                self.marks.append((d, s - int(self.bounds[d]), c))
        return np.flatnonzero(stay)


def _tags(value: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each hash, and the bytes of it that are sent."""
    return (value % np.uint64(buckets)).astype(np.int64), (value // np.uint64(buckets)) & np.uint64((1 << 8 * TAG) - 1)


def _narrow(tags: np.ndarray) -> bytes:
    return np.ascontiguousarray(tags.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TAG]).tobytes()


def _wide(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // TAG, 8), np.uint8)
    out[:, :TAG] = np.frombuffer(blob, np.uint8).reshape(-1, TAG)
    return out.view("<u8").ravel()


def _edges(ordered: np.ndarray) -> Iterator[tuple[int, int]]:
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(ordered) else []
    return zip(at, at[1:])


def _hashes(length: int, buckets: int):
    """(bucket, chunk, tags): the hashes of a chunk, and whether two of its pieces share them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, sizes, texts in zip(*(c.to_pylist() for c in batch.columns)):
                made = Pieces(ids, sizes, texts, length)
                value, times = np.unique(made.value, return_counts=True)
                bucket, tag = _tags(value, buckets)
                order = np.argsort(bucket, kind="stable")
                bucket, tag, times = bucket[order], tag[order], times[order]
                numbers, tags, twice = [], [], []
                for s, e in _edges(bucket):
                    numbers.append(int(bucket[s]))
                    tags.append(_narrow(tag[s:e]))
                    twice.append(_narrow(tag[s:e][times[s:e] > 1]))
                n = len(numbers)
                yield pa.record_batch(
                    [pa.array(numbers, pa.int64()), pa.array([chunk] * n, pa.int64()), pa.array(tags, pa.binary()), pa.array(twice, pa.binary())],
                    names=["bucket", "chunk", "tags", "twice"],
                )

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk the tags that another chunk, or another piece of it, has too."""
    tags = [_wide(t.as_py()) for t in table["tags"]]
    value = np.concatenate(tags)
    order = np.argsort(value, kind="stable")
    same = value[order][1:] == value[order][:-1]
    several = np.zeros(len(value), bool)
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    ends = np.cumsum([len(t) for t in tags])
    chunk, out = [], []
    for number, own, end, twice in zip(table["chunk"].to_pylist(), tags, ends, table["twice"]):
        asked, twice = own[several[end - len(own) : end]], _wide(twice.as_py())
        asked = np.union1d(asked, twice) if len(twice) else asked
        if len(asked):
            chunk.append(number)
            out.append(_narrow(asked))
    bucket = table["bucket"][0].as_py()
    return pa.table(
        {
            "of": pa.array(chunk, pa.int64()),
            "bucket": pa.array([bucket] * len(chunk), pa.int64()),
            "asked": pa.array(out, pa.binary()),
        }
    )


def _dealt(length: int, buckets: int):
    """Of one chunk: the pieces whose tags are asked for, dealt to buckets, and marks found in the chunk itself."""

    def run(table: pa.Table, asked: pa.Table) -> pa.Table:
        ids, sizes, texts = (table[c][0].as_py() for c in ("ids", "sizes", "texts"))
        chunk = table["chunk"][0].as_py()
        made = Pieces(ids, sizes, texts, length)
        bucket, tag = _tags(made.value, buckets)
        order = np.argsort(bucket, kind="stable")
        wanted = np.zeros(len(order), bool)
        edges = {int(bucket[order[s]]): (s, e) for s, e in _edges(bucket[order])}
        for number, tags in zip(asked["bucket"].to_pylist(), asked["asked"]):
            s, e = edges[number]
            wanted[order[s:e]] = np.isin(tag[order[s:e]], _wide(tags.as_py()))
        for name in ("doc", "place", "value", "count"):
            setattr(made, name, getattr(made, name)[wanted])
        bucket, tag = bucket[wanted], tag[wanted]
        picked = made.drop_copies(length)
        picked = picked[np.argsort(bucket[picked], kind="stable")]
        offset = made.place - made.bounds[made.doc]
        numbers, blobs = [], []
        for s, e in _edges(bucket[picked]):
            own = picked[s:e]
            text = b"".join(
                made.whole[p : p + c + length - 1] for p, c in zip(made.place[own].tolist(), made.count[own].tolist())
            )
            parts = [np.array([len(own)]), made.ids[made.doc[own]], made.doc[own], offset[own], made.count[own]]
            numbers.append(int(bucket[own[0]]))
            blobs.append(_packed([p.astype("<i8") for p in parts] + [tag[own].astype("<u8"), text]))
        marks = [None] * len(numbers)
        if made.marks:
            numbers.append(chunk % buckets)
            blobs.append(None)
            marks.append(_packed([np.array(made.marks, "<i8")]))
        columns = [numbers, [chunk] * len(numbers), blobs, marks]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

    return run


def smallest_grams(raw: np.ndarray, length: int) -> np.ndarray:
    """Of each place, the smallest hash of the grams within the string of ``length`` bytes from there on."""
    out, want = np.empty(len(raw), np.uint64), length - GRAM + 1
    for a in range(0, len(raw), BLOCK):  # blocks stay in a core's cache
        word = eight(raw[a : a + BLOCK + length + 8])
        tail = np.zeros(len(word), np.uint64)
        tail[:-8] = word[8:]
        word *= _A
        tail *= _B
        word += tail
        np.right_shift(word, np.uint64(32), out=tail)
        word ^= tail
        word *= _C
        np.right_shift(word, np.uint64(29), out=tail)
        word ^= tail
        have = 1
        while have < want and have < len(word):
            step = min(have, want - have)
            np.minimum(word[:-step], word[step:], out=tail[:-step])
            tail[-step:] = word[-step:]
            word, tail = tail, word
            have += step
        size = min(BLOCK, len(raw) - a)
        out[a : a + size] = word[:size]
    return out


# ---- buckets


def _opened(blob: bytes) -> tuple[np.ndarray, ...]:
    plain = _plain(blob)
    n = int(np.frombuffer(plain, "<i8", 1)[0])
    numbers = np.frombuffer(plain, "<i8", 5 * n, 8).reshape(5, n)
    return (*numbers, plain[8 + 40 * n :])


def _found(length: int):
    """Of one bucket: (chunk, marks) of the strings that a smaller document has."""

    def run(table: pa.Table) -> pa.Table:
        passed = table.filter(pa.compute.is_valid(table["marks"])).select(["chunk", "marks"])
        table = table.filter(pa.compute.is_valid(table["pieces"]))
        if not table.num_rows:
            return passed
        opened = [_opened(b.as_py()) for b in table["pieces"]]
        ids, doc, offset, count, tag = (np.concatenate([o[k] for o in opened]) for k in range(5))
        chunk = np.repeat(table["chunk"].to_numpy(), [len(o[0]) for o in opened])
        whole = b"".join(o[5] for o in opened)
        del opened
        begins = np.concatenate([[0], np.cumsum(count + length - 1)]).tolist()
        own_id, own_tag = ids.tolist(), tag.tolist()
        first, heads, gone, again, kinds = {}, [], [], {}, {}
        for k in np.argsort(ids, kind="stable").tolist():
            own = first.setdefault(whole[begins[k] : begins[k + 1]], len(heads))
            if own == len(heads):
                heads.append(k)
                kinds.setdefault(own_tag[k], []).append(own)
            elif own_id[heads[own]] < own_id[k]:
                gone.append(k)
            else:
                again.setdefault(own, []).append(k)
        texts = list(first)
        del first
        # of pieces with one hash, only different ones are left to compare
        members, groups, held = [], [], 0
        for own in (own for same in kinds.values() if len(same) > 1 for own in same):
            if held + len(texts[own]) > SHARD and groups:
                members.append(groups)
                groups, held = [], 0
            groups.append(own)
            held += len(texts[own])
        if groups:
            members.append(groups)
        shards = []
        for groups in members:
            least = np.array([own_id[heads[own]] for own in groups], np.int64)
            shards.append(Shard([texts[own] for own in groups], least, length))
        merge(shards)
        found = []
        for shard, groups in zip(shards, members):
            for piece, start, n in shard.removed():
                found += [(k, start, n) for k in (heads[groups[piece]], *again.get(groups[piece], ()))]
        gone = np.array(gone, np.int64)
        found = np.concatenate(
            [np.array(found, np.int64).reshape(-1, 3), np.stack([gone, np.zeros(len(gone), np.int64), count[gone]], 1)]
        )
        k = found[:, 0]
        rows = np.stack([doc[k], offset[k] + found[:, 1], found[:, 2]], 1)
        order = np.lexsort((rows[:, 1], rows[:, 0], chunk[k]))
        numbers, marks = [], []
        for s, e in _edges(chunk[k][order]):
            numbers.append(int(chunk[k[order[s]]]))
            marks.append(_packed([rows[order[s:e]].astype("<i8")]))
        mine = pa.table({"chunk": pa.array(numbers, pa.int64()), "marks": pa.array(marks, pa.binary())})
        return pa.concat_tables([passed, mine])

    return run


def _removed(length: int):
    """Of one chunk: every document with the runs of bytes that are removed and the bytes that stay."""

    def run(table: pa.Table, marked: pa.Table) -> pa.Table:
        ids, sizes, texts = (table[c][0].as_py() for c in ("ids", "sizes", "texts"))
        whole = _plain(texts)
        bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        marks = [np.frombuffer(_plain(m.as_py()), "<i8").reshape(-1, 3) for m in marked["marks"]]
        marks = np.concatenate([*marks, np.empty((0, 3), np.int64)])
        start = bounds[marks[:, 0]] + marks[:, 1]
        stop = start + marks[:, 2] + length - 1
        order = np.argsort(start, kind="stable")
        start, stop, doc = start[order], stop[order], marks[order, 0]
        stop = np.maximum.accumulate(stop) if len(stop) else stop  # marks don't leave their document
        lead = np.ones(len(start), bool)
        lead[1:] = (start[1:] > stop[:-1]) | (doc[1:] != doc[:-1])
        lead = np.flatnonzero(lead)
        if len(lead):
            start, stop, doc = start[lead], stop[np.append(lead[1:], len(stop)) - 1], doc[lead]
        at = np.searchsorted(doc, np.arange(len(ids) + 1))
        spans, kept = [], []
        for k, (s, e) in enumerate(zip(at, at[1:])):
            runs = list(zip(start[s:e].tolist(), stop[s:e].tolist()))
            edges = [int(bounds[k]), *(x for run in runs for x in run), int(bounds[k + 1])]
            spans.append([{"start": a - edges[0], "stop": b - edges[0]} for a, b in runs])
            kept.append(b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2])))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, kind),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``docs`` (doc_id, text): the runs of bytes removed, and the
    bytes that stay (they may end inside a character)."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = keep(texts.mapInArrow(_chunked, CHUNKS), "chunks", tidy=True)
    total = chunks.select(F.aggregate("sizes", F.lit(0).cast("long"), lambda n, s: n + s).alias("n"))
    total = total.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET))
    hashes = chunks.mapInArrow(_hashes(length, buckets), "bucket long, chunk long, tags binary, twice binary")
    asked = keep(hashes.groupBy("bucket").applyInArrow(_shared, "of long, bucket long, asked binary"), "asked", tidy=True)
    pieces = (
        chunks.groupBy("chunk")
        .cogroup(asked.groupBy("of"))
        .applyInArrow(_dealt(length, buckets), "bucket long, chunk long, pieces binary, marks binary")
    )
    found = keep(pieces.groupBy("bucket").applyInArrow(_found(length), "chunk long, marks binary"), "marks", tidy=True)
    made = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
    found = found.select(F.col("chunk").alias("of"), "marks")
    return chunks.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(_removed(length), made)
