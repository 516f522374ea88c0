"""Alignment of two tokenizers' tokens over the bytes of every text, with corpus-wide pair counts.

Tokenizer A is a byte-level BPE, tokenizer B a sentence-piece BPE. Where a byte is the last of an A token and of a
B token the tokens are cut into groups. An identity map from A ids to the B ids of the same bytes is computed
once; a group of one A and one B token that the map holds is exact, and exact groups are only counted, in a
vector as long as A's vocabulary. The links of all other groups are pairs: they are summed per chunk of texts,
then by a shuffle, and each chunk fetches the totals of the pairs it holds.

Defined results: null or empty texts, and texts whose joined tokens differ from a space and the text, have no
tokens; a null doc_id is passed through; repeated rows each count; an empty table gives no rows; further
columns are not read; a text of any length is encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.store import bound_batches, keep

#: Bytes of text in a chunk, whose pairs are summed before they are shuffled, and of texts encoded at once.
CHUNK, PIECE = 1 << 21, 1 << 18
DOC, PAIR, EXACT = 0, 1, 2
ENCODED = (
    "kind byte, chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, exact binary, pairs binary, pair long, n long"
)
_SCHEMA = pa.schema(
    [
        ("kind", pa.int8()),
        *((n, pa.int64()) for n in ("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()),
        ("exact", pa.binary()),
        ("pairs", pa.binary()),
        ("pair", pa.int64()),
        ("n", pa.int64()),
    ]
)


class Tokenizers(NamedTuple):
    """Files of both tokenizers, at the same place on every machine."""

    a: str = "/opt/tokenizers/byte_bpe_50k.json"
    b: str = "/opt/tokenizers/piece_bpe_32k.model"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, then from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


#: How a byte-level BPE cuts texts before its merges.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _by_ranks(file: str, letters: dict[str, int]):
    """An encoder by ranks for a file whose ids are its merges in order and that does nothing else to a text.

    It gives the same ids several times as fast; None for any other file.
    """
    with open(file, encoding="utf-8") as f:
        held = json.load(f)
    model, cut = held["model"], held["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(
        (held["normalizer"], held["post_processor"], model["unk_token"], model["continuing_subword_prefix"])
    )
    plain = plain and not any((model["end_of_word_suffix"], model["byte_fallback"], model["dropout"]))
    plain = plain and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
    if not plain or not all(x in letters for token in model["vocab"] for x in token):
        return None
    raw = lambda token: bytes(letters[x] for x in token)
    ranks = {raw(token): i for token, i in model["vocab"].items()}
    parts = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merged = [ranks[raw("".join(m))] for m in parts]
    if merged != list(range(256, 256 + len(merged))) or {ranks[bytes([b])] for b in range(256)} != set(range(256)):
        return None
    from tiktoken import Encoding

    return Encoding("a", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Pair:
    """Both tokenizers loaded: their tokens' bytes, and the identity map from A ids to B ids."""

    def __init__(self, files: Tokenizers) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(files.a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=files.b)
        letters = _byte_letters()
        self.fast_a = _by_ranks(files.a, letters)
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[x] for x in token) if all(x in letters for x in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(
                bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            )
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        plain = {x: i for i, x in reversed(list(enumerate(self.bytes_b))) if not self.b.is_byte(i)}
        single = {x: i for i, x in enumerate(self.bytes_b) if self.b.is_byte(i)}
        same = single | plain  # a piece is met before a lone byte
        self.identity = np.array([same.get(x, -1) for x in self.bytes_a], np.int64)
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.names = [
            *(f"{i}," for i in a),
            *(f"{i}|" for i in a),
            *(f"{i}," for i in b),
            *(f"{i};" for i in b),
        ]

    @property
    def size_a(self) -> int:
        return len(self.bytes_a)

    @property
    def size_b(self) -> int:
        return len(self.bytes_b)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of the texts in both vocabularies, none for texts that either one doesn't give back byte for byte."""
        spaced = [" " + t for t in texts]
        if self.fast_a:
            ids_a = [self.fast_a(t) for t in spaced]
        else:
            ids_a = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode(texts, num_threads=1)
        whole_a, whole_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for k, text in enumerate(spaced):
            raw = text.encode()
            if not texts[k] or b"".join(map(whole_b, ids_b[k])) != raw or b"".join(map(whole_a, ids_a[k])) != raw:
                ids_a[k], ids_b[k] = [], []
        return ids_a, ids_b


@functools.lru_cache(maxsize=2)
def load(files: Tokenizers) -> Pair:
    return Pair(files)


class Aligned(NamedTuple):
    """Texts side by side: links in the order of their bytes, cut by ``links_at``; groups as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    links_at: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    exact: np.ndarray
    names: list[str]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def align(pair: Pair, ids_a: list[list[int]], ids_b: list[list[int]]) -> Aligned:
    """Groups and links of texts whose A and B tokens cover the same bytes.

    Between two neighbouring token ends, of either side, lies exactly one link.
    """
    n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
    a = np.fromiter((i for x in ids_a for i in x), np.int64, int(n_a.sum()))
    b = np.fromiter((i for x in ids_b for i in x), np.int64, int(n_b.sum()))
    ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    size = int(ends_a[-1]) if len(a) else 0
    ends = np.zeros(size + 1, np.int8)  # bit 0: an A token ends before this byte, bit 1: a B token
    ends[ends_a] |= 1
    ends[ends_b] |= 2
    cuts = np.flatnonzero(ends)
    kind = ends[cuts]
    last_a, last_b = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64)
    at_a, at_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # token that holds the bytes before a cut
    both = kind == 3
    group = np.cumsum(both) - both  # of each link
    ngroups = int(both.sum())
    group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    group_a[at_a], group_b[at_b] = group, group
    in_a, in_b = np.bincount(group_a, minlength=ngroups), np.bincount(group_b, minlength=ngroups)
    link_a, link_b = a[at_a], b[at_b]
    exact = ((in_a == 1) & (in_b == 1))[group] & (pair.identity[link_a] == link_b)
    # tokens in the order of the text form: a group's A tokens, then its B tokens
    before_a, before_b = _starts(in_a), _starts(in_b)
    spot_a = np.arange(len(a)) + before_b[group_a]
    spot_b = np.arange(len(b)) + before_a[group_b + 1]
    name = np.empty(len(a) + len(b), np.int64)
    closes_a = np.zeros(len(a), bool)
    closes_a[before_a[1:] - 1] = True
    closes_b = np.zeros(len(b), bool)
    closes_b[before_b[1:] - 1] = True
    name[spot_a] = a + closes_a * pair.size_a
    name[spot_b] = 2 * pair.size_a + b + closes_b * pair.size_b
    cut_at = _starts(n_a + n_b)
    text = pair.names.__getitem__
    names = ["".join(map(text, name[s:e].tolist()))[:-1] for s, e in zip(cut_at, cut_at[1:])]
    # links and groups of each text: those up to its last byte
    ends_at = np.concatenate([[0], ends_a])[_starts(n_a)[1:]] if len(a) else np.zeros(len(n_a), np.int64)
    links_at = np.concatenate([[0], np.searchsorted(cuts, ends_at, side="right")])
    groups_at = np.concatenate([[0], np.searchsorted(cuts[both], ends_at, side="right")])
    return Aligned(n_a, n_b, np.diff(groups_at), links_at, link_a, link_b, exact, names)


def _encoded(files: Tokenizers):
    """Rows of one task: documents with their packed links, the pairs of each chunk, the vector of exact groups."""

    def rows(kind: int, size: int, **columns) -> pa.RecordBatch:
        made = {"kind": pa.array(np.full(size, kind, np.int8))} | columns
        return pa.record_batch(
            [made[f.name].cast(f.type) if f.name in made else pa.nulls(size, f.type) for f in _SCHEMA], schema=_SCHEMA
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(files)
        vector = np.zeros(pair.size_a, np.int64)
        first = TaskContext.get().partitionId() << 32
        chunk, held, waiting = 0, 0, []

        def piece(doc_id: list, texts: list[str]) -> pa.RecordBatch:
            found = align(pair, *pair.encode(texts))
            exact, odd = found.exact, ~found.exact
            vector[:] += np.bincount(found.link_a[exact], minlength=pair.size_a)
            pairs = found.link_a * pair.size_b + found.link_b
            waiting.append(pairs[odd])
            cut = list(zip(found.links_at, found.links_at[1:]))
            return rows(
                DOC,
                len(texts),
                chunk=pa.array(np.full(len(texts), first + chunk)),
                doc_id=pa.array(doc_id, pa.int64()),
                n_a=pa.array(found.n_a),
                n_b=pa.array(found.n_b),
                n_groups=pa.array(found.n_groups),
                n_links=pa.array(np.diff(found.links_at)),
                groups_sha256=pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in found.names]),
                exact=pa.array([found.link_a[s:e][exact[s:e]].astype("<u4").tobytes() for s, e in cut], pa.binary()),
                pairs=pa.array([pairs[s:e][odd[s:e]].astype("<u8").tobytes() for s, e in cut], pa.binary()),
            )

        def close() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            for s in range(0, len(pairs), 1 << 16):
                own = pairs[s : s + (1 << 16)]
                yield rows(
                    PAIR,
                    len(own),
                    chunk=pa.array(np.full(len(own), first + chunk)),
                    pair=pa.array(own),
                    n=pa.array(n[s : s + (1 << 16)]),
                )

        for batch in batches:
            sizes = np.diff(np.concatenate([[0], np.cumsum([len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch.column(1).cast(pa.large_string())])]))
            at = 0
            while at < batch.num_rows:
                stop, total = at + 1, int(sizes[at])
                while stop < batch.num_rows and total + sizes[stop] <= PIECE:
                    total += int(sizes[stop])
                    stop += 1
                own = batch.slice(at, stop - at)
                yield piece(own.column(0).to_pylist(), [t or "" for t in own.column(1).to_pylist()])
                at, held = stop, held + total
                if held >= CHUNK:
                    yield from close()
                    chunk, held = chunk + 1, 0
        if waiting:
            yield from close()
        ids = np.flatnonzero(vector)
        if len(ids):
            yield rows(EXACT, len(ids), pair=pa.array(ids * pair.size_b + pair.identity[ids]), n=pa.array(vector[ids]))

    return run


def _scored(size_a: int, size_b: int, exact_n: np.ndarray, exact_best: np.ndarray):
    """Documents of one chunk with the totals of its pairs: sums over all their links."""

    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        pair = totals["pair"].to_numpy()
        order = np.argsort(pair)
        pair, n, best = pair[order], totals["total"].to_numpy()[order], totals["best"].to_numpy()[order]
        n_best, count_sum = [], []
        for exact, pairs in zip(docs["exact"], docs["pairs"]):
            ids = np.frombuffer(exact.as_buffer(), "<u4")
            at = np.searchsorted(pair, np.frombuffer(pairs.as_buffer(), "<u8").astype(np.int64))
            n_best.append(int(exact_best[ids].sum() + best[at].sum()))
            count_sum.append(int(exact_n[ids].sum() + n[at].sum()))
        out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(n_best, pa.int64()))
        out = out.append_column("count_sum", pa.array(count_sum, pa.int64()))
        return out.append_column("groups_sha256", docs["groups_sha256"])

    return run


def pair_counts(encoded: DataFrame, size_b: int) -> DataFrame:
    """(pair, total, exact, best) of all links; ``best`` where no other A id meets the B id more often."""
    counted = encoded.where(F.col("kind") != DOC).groupBy("pair")
    counts = keep(
        counted.agg(F.sum("n").alias("total"), F.max(F.col("kind") == EXACT).alias("exact")).withColumn(
            "b", F.col("pair") % size_b
        ),
        "counts",
    )
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    return counts.join(most, "b").select("pair", "total", "exact", (F.col("total") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, files: Tokenizers = Tokenizers()) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` (doc_id, text): one row per document with its tokens, groups, links and their counts, and the
    table (a, b, n, best) of all id pairs."""
    bound_batches(docs.sparkSession)
    pair = load(files)
    encoded = keep(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encoded(files), ENCODED), "encoded")
    counts = keep(pair_counts(encoded, pair.size_b), "pairs")
    # at most one row for each id of A
    vector = counts.where("exact").toPandas()
    exact_n, exact_best = np.zeros(pair.size_a, np.int64), np.zeros(pair.size_a, bool)
    ids = vector["pair"].to_numpy(np.int64) // pair.size_b
    exact_n[ids], exact_best[ids] = vector["total"], vector["best"]
    asked = encoded.where(F.col("kind") == PAIR).select(F.col("chunk").alias("of"), "pair")
    totals = asked.join(counts, "pair").select("of", "pair", "total", "best")
    held = encoded.where(F.col("kind") == DOC).select(
        "chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "exact", "pairs"
    )
    scored = (
        held.groupBy("chunk")
        .cogroup(totals.groupBy("of"))
        .applyInArrow(
            _scored(pair.size_a, pair.size_b, exact_n, exact_best),
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string",
        )
    )
    table = counts.select(
        F.floor(F.col("pair") / pair.size_b).cast("int").alias("a"),
        (F.col("pair") % pair.size_b).cast("int").alias("b"),
        F.col("total").alias("n"),
        "best",
    )
    return scored, table
