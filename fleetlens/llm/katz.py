"""Language-model scoring by Katz backoff over word bigrams with Good-Turing discounts.

    P(w | h) = d(c) c(h w) / c(h)      if c(h w) >= least      (d from the counts of counts, 1 above K)
             = alpha(h) P(w)           otherwise
    P(w)     = d(c) c(w) / N           if w was seen, else the mass left over, for the one unknown word

alpha(h) is exact: the mass that the kept bigrams of h leave, over the unigram mass of all words outside
them, so P(. | h) adds up to 1 over the vocabulary and the unknown word. The query keeps every bigram that
was seen (least = 1); ``build`` alone takes those seen once as unseen, as in Katz's own experiments, unless
it is told otherwise.

The texts are cut into blocks, stored in a table bucketed by block. What a block needs from the corpus it
asks for: its distinct words (and later word pairs) go, packed by bucket, to the task that adds up the
counts of that bucket over all blocks, stores them in the model's tables and sends the totals back in the
order of the request. The block's tasks then read the replies beside their own part of the table. A word
or pair sends one entry per block, however frequent it is.

Nulls, ties and odd rows: a null text is the end token alone; a null doc_id is scored but not learned
from; repeated rows count each time; other columns are ignored; with nothing to learn from, every token is
the unknown word with probability 1; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import text as tx
from fleetlens.llm.language import remainder
from fleetlens.llm.store import keep, shared_folder

K = 5
BLOCK_TOKENS = 1 << 21
END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)

BLOCKS = "block long, doc_ids array<long>, learn array<boolean>, lengths array<int>, words array<long>, ids array<int>"


def _ints(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def _block(number: int, ids: list, learn: list, counts: np.ndarray, tokens: np.ndarray) -> pa.RecordBatch:
    bounds = np.cumsum(counts)
    tokens = np.insert(tokens, bounds, END)
    words, place = np.unique(tokens, return_inverse=True)
    return pa.record_batch(
        [
            pa.array([number], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([learn], pa.list_(pa.bool_())),
            _ints((counts + 1).astype(np.int32), np.array([0, len(counts)])),
            _ints(words.view(np.int64), np.array([0, len(words)])),
            _ints(place.astype(np.int32), np.array([0, len(place)])),
        ],
        names=["block", "doc_ids", "learn", "lengths", "words", "ids"],
    )


def _cut(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, learn, counts, tokens, size = [], [], [], [], 0
        for batch in batches:
            names, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, n, found in tx.words(batch.column(2), tx.NON_BLANK):
                ids += names[row : row + len(n)]
                learn += wanted[row : row + len(n)]
                counts.append(n)
                tokens.append(found)
                size += len(found) + len(n)
                if size >= block_tokens:
                    yield _block(number, ids, learn, np.concatenate(counts), np.concatenate(tokens))
                    ids, learn, counts, tokens, size, number = [], [], [], [], 0, number + 1
        if ids:
            yield _block(number, ids, learn, np.concatenate(counts), np.concatenate(tokens))

    return run


@dataclass
class Block:
    number: int
    doc_ids: list
    learn: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, row: pa.Table | pa.RecordBatch, i: int) -> Block:
        def flat(name: str) -> np.ndarray:
            return row.column(name)[i].values.to_numpy(zero_copy_only=False)

        return cls(
            row.column("block")[i].as_py(),
            row.column("doc_ids")[i].as_py(),
            np.array(row.column("learn")[i].as_py(), bool),
            flat("lengths"),
            flat("words").view(np.uint64),
            flat("ids"),
        )

    @property
    def learned(self) -> np.ndarray:
        return np.repeat(self.learn, self.lengths)

    def histories(self) -> np.ndarray:
        """Index of the word before each token; len(words) for the start of a text."""
        before = np.empty(len(self.ids), np.int64)
        before[1:] = self.ids[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = len(self.words)
        return before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (history, word) of this block by their code, and the pair of each token."""
        code = self.histories() * len(self.words) + self.ids
        pairs, place = np.unique(code, return_inverse=True)
        return pairs // len(self.words), pairs % len(self.words), place

    def history_words(self) -> np.ndarray:
        return np.append(self.words, START)


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by (bucket, hash), and where each bucket begins in it."""
    where = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, where))
    return order, np.searchsorted(where[order], np.arange(buckets + 1))


def _request(block: int, hashes: np.ndarray, values: np.ndarray, buckets: int) -> pa.RecordBatch:
    order, bounds = by_bucket(hashes, buckets)
    full = np.flatnonzero(np.diff(bounds))
    ends = np.append(bounds[full], bounds[-1])
    values = values[order]
    columns = [values] if values.ndim == 1 else list(values.T)
    return pa.record_batch(
        [
            pa.array(np.full(len(full), block), pa.int64()),
            pa.array(full, pa.int64()),
            _ints(hashes[order].view(np.int64), ends),
            *(_ints(np.ascontiguousarray(c), ends) for c in columns),
        ],
        names=["block", "bucket", "keys", *(f"v{i}" for i in range(len(columns)))],
    )


def pair_hash(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    return tx.mix(history * np.uint64(3) + tx.mix(word))


def _word_requests(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block = Block.of(batch, i)
                n = np.bincount(block.ids[block.learned], minlength=len(block.words))
                yield _request(block.number, block.words, n.astype(np.int64), buckets)

    return run


def _pair_requests(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block = Block.of(batch, i)
                first, second, place = block.pairs()
                n = np.bincount(place[block.learned], minlength=len(first))
                hashes = pair_hash(block.history_words()[first], block.words[second])
                yield _request(block.number, hashes, n.astype(np.int64), buckets)

    return run


REPLY = "block long, bucket long, keys array<long>, values array<long>, sizes array<long>"


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _add_up(least: int):
    """Totals of one bucket: a model row (no block), with the counts of counts, and a reply per block.

    Totals under ``least`` are answered as 0 and not stored. A reply is twice the total, plus 1 for the
    first block that has the key, so that each key has one block that speaks for it.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        keys, n = _flat(table["keys"]), _flat(table["v0"])
        lengths = pa.compute.list_value_length(table["keys"]).to_numpy()
        known, first, place = np.unique(keys, return_index=True, return_inverse=True)
        totals = np.zeros(len(known), np.int64)
        np.add.at(totals, place, n)
        sizes = np.bincount(np.minimum(totals, K + 2), minlength=K + 3)[1:]
        answer = np.where(totals >= least, 2 * totals, 0)[place]
        answer[first[totals >= least]] += 1
        stored = totals >= least
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        bucket = table["bucket"][0].as_py()
        model = pa.table(
            {
                "block": pa.array([None], pa.int64()),
                "bucket": pa.array([bucket], pa.int64()),
                "keys": _ints(known[stored], np.array([0, stored.sum()])),
                "values": _ints(totals[stored], np.array([0, stored.sum()])),
                "sizes": _ints(np.append(sizes, totals.sum()), np.array([0, len(sizes) + 1])),
            }
        )
        replies = pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "keys": pa.nulls(len(table), pa.list_(pa.int64())),
                "values": _ints(answer, bounds),
                "sizes": pa.nulls(len(table), pa.list_(pa.int64())),
            }
        )
        return pa.concat_tables([model, replies])

    return run


def discounts(sizes: np.ndarray) -> np.ndarray:
    """Good-Turing discount of each count 0..K, 1 where the counts of counts allow none."""
    out = np.ones(K + 2)
    if sizes[0] > 0:
        share = (K + 1) * sizes[K] / sizes[0]
        for r in range(1, K + 1):
            if sizes[r - 1] > 0 and share < 1:
                d = ((r + 1) * sizes[r] / (r * sizes[r - 1]) - share) / (1 - share)
                out[r] = d if 0 < d <= 1 else 1.0
    return out


@dataclass
class Unigrams:
    """Constants of the unigram level: P(w) is a function of c(w) alone."""

    tokens: int
    types: int
    scale: np.ndarray
    total: float
    unknown: float

    @classmethod
    def of(cls, sizes: np.ndarray, tokens: int) -> Unigrams:
        scale = discounts(sizes)
        if not tokens:
            return cls(0, 0, scale, 1.0, 1.0)
        kept = 1 - sum((1 - scale[r]) * r * sizes[r - 1] for r in range(1, K + 1)) / tokens
        if kept < 1 - 1e-12:
            return cls(tokens, int(sizes.sum()), scale, float(tokens), 1 - kept)
        return cls(tokens, int(sizes.sum()), np.ones(K + 2), tokens + 1.0, 1 / (tokens + 1.0))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.scale[np.minimum(counts, K + 1)] * counts / self.total, self.unknown)


@dataclass
class Replies:
    """What a block was told, in the order of its own words and pairs."""

    counts: np.ndarray
    pair_totals: np.ndarray
    speaks: np.ndarray


def _answers(rows: pa.Table, kind: str, order: np.ndarray) -> np.ndarray:
    own = rows.filter(pa.compute.equal(rows["kind"], kind)).sort_by("bucket")
    out = np.empty(len(order), np.int64)
    out[order] = _flat(own["values"])
    return out


def _replies(block: Block, rows: pa.Table, buckets: int, hashes: np.ndarray) -> Replies:
    words = _answers(rows, "word", by_bucket(block.words, buckets)[0]) // 2
    pairs = _answers(rows, "pair", by_bucket(hashes, buckets)[0])
    return Replies(words, pairs // 2, pairs % 2 == 1)


def _history_counts(block: Block, counts: np.ndarray, texts: int) -> np.ndarray:
    """c(h) of each own word and of the start of a text."""
    return np.append(counts, texts).astype(np.float64)


def _asked(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Histories of a block's pairs that the corpus may hold; their kept bigrams may all stand in other blocks."""
    return np.flatnonzero((np.bincount(first, minlength=len(counts) + 1) > 0) & np.append(counts > 0, True))


def _history_requests(buckets: int, unigrams: Unigrams, scale: np.ndarray):
    """Of one block: the histories that stand here, with the discounted counts and unigram mass of those
    kept bigrams that this block speaks for."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.of(left, 0)
        first, second, _ = block.pairs()
        hashes = pair_hash(block.history_words()[first], block.words[second])
        told = _replies(block, right, buckets, hashes)
        kept = told.pair_totals > 0
        own = kept & told.speaks
        n = len(block.words) + 1
        used = scale[np.minimum(told.pair_totals[own], K + 1)] * told.pair_totals[own]
        mass = np.bincount(first[own], used, n).astype(np.float64)
        lower = np.bincount(first[own], unigrams.probability(told.counts[second[own]]), n).astype(np.float64)
        asked = _asked(first, told.counts)
        batch = _request(
            block.number, block.history_words()[asked], np.stack([mass[asked], lower[asked]], 1), buckets
        )
        return pa.Table.from_batches([batch])

    return run


def _add_histories(table: pa.Table) -> pa.Table:
    """Sums of one bucket's histories: a model row and a reply per block (two numbers per history)."""
    table = table.sort_by("block")
    keys, mass, lower = _flat(table["keys"]), _flat(table["v0"]), _flat(table["v1"])
    lengths = pa.compute.list_value_length(table["keys"]).to_numpy()
    known, place = np.unique(keys, return_inverse=True)
    sums = np.stack([np.bincount(place, mass, len(known)), np.bincount(place, lower, len(known))], 1)
    sums = sums.astype(np.float64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    bits = sums.view(np.int64)
    return pa.concat_tables(
        [
            pa.table(
                {
                    "block": pa.array([None], pa.int64()),
                    "bucket": table["bucket"][:1],
                    "keys": _ints(known, np.array([0, len(known)])),
                    "values": _ints(bits.ravel(), np.array([0, 2 * len(known)])),
                    "sizes": pa.nulls(1, pa.list_(pa.int64())),
                }
            ),
            pa.table(
                {
                    "block": table["block"],
                    "bucket": table["bucket"],
                    "keys": pa.nulls(len(table), pa.list_(pa.int64())),
                    "values": _ints(bits[place].ravel(), 2 * bounds),
                    "sizes": pa.nulls(len(table), pa.list_(pa.int64())),
                }
            ),
        ]
    )


def backoff(mass: np.ndarray, lower: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, alpha) per history, from the discounted counts of its kept bigrams and the unigram
    mass of their words. A history whose bigrams would leave nothing gives up one count."""
    total = np.where(counts - mass > 1e-9 * counts, counts, counts + 1)
    return total, np.where(mass > 0, (1 - mass / total) / np.maximum(1 - lower, 1e-300), 1.0)


SCORES = (
    "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _scores(buckets: int, unigrams: Unigrams, scale: np.ndarray, texts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.of(left, 0)
        first, second, place = block.pairs()
        hashes = pair_hash(block.history_words()[first], block.words[second])
        told = _replies(block, right, buckets, hashes)
        n = len(block.words) + 1
        kept = told.pair_totals > 0
        asked = _asked(first, told.counts)
        mass, lower = np.zeros(n), np.zeros(n)
        if len(asked):
            order, _ = by_bucket(block.history_words()[asked], buckets)
            own = right.filter(pa.compute.equal(right["kind"], "history")).sort_by("bucket")
            sums = np.empty((len(asked), 2))
            sums[order] = _flat(own["values"]).view(np.float64).reshape(-1, 2)
            mass[asked], lower[asked] = sums[:, 0], sums[:, 1]
        total, alpha = backoff(mass, lower, _history_counts(block, told.counts, texts))
        single = unigrams.probability(told.counts)
        totals = told.pair_totals
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = scale[np.minimum(totals, K + 1)] * totals / total[first]
        chance = np.where(kept, direct, alpha[first] * single[second])
        logs = np.log10(chance)[place]
        base = np.log10((told.counts + 0.5) / (unigrams.tokens + 0.5 * (unigrams.types + 1)))[block.ids]
        begins = np.cumsum(block.lengths) - block.lengths
        return pa.table(
            {
                "doc_id": pa.array(block.doc_ids, pa.int64()),
                "n_tokens": block.lengths.astype(np.int64),
                "n_known": np.add.reduceat((told.counts > 0)[block.ids].astype(np.int64), begins),
                "train_tokens": np.full(len(begins), unigrams.tokens),
                "base_score": np.add.reduceat(base, begins),
                "score": np.add.reduceat(logs, begins),
            }
        )

    return run


def _sizes(table: DataFrame) -> np.ndarray:
    """Counts of counts of a model table (1..K+1, then all above), and the sum of all counts."""
    sums = table.where("block is null").agg(*(F.sum(F.col("sizes")[i]) for i in range(K + 3))).first()
    return np.array([x or 0 for x in sums], np.int64)


@dataclass
class KatzModel:
    blocks: DataFrame
    words: DataFrame
    pairs: DataFrame
    histories: DataFrame
    unigrams: Unigrams
    scale: np.ndarray
    texts: int
    buckets: int

    def replies(self, *kinds: str) -> DataFrame:
        found = None
        for kind in kinds:
            own = getattr(self, {"word": "words", "pair": "pairs", "history": "histories"}[kind])
            own = own.where("block is not null").select(
                F.col("block").alias("to"), F.lit(kind).alias("kind"), "bucket", "values"
            )
            found = own if found is None else found.union(own)
        return found

    def scores(self) -> DataFrame:
        told = self.replies("word", "pair", "history")
        run = _scores(self.buckets, self.unigrams, self.scale, self.texts)
        return self.blocks.groupBy("block").cogroup(told.groupBy("to")).applyInArrow(run, SCORES)


def build(docs: DataFrame, learn, block_tokens: int = BLOCK_TOKENS, least: int = 2) -> KatzModel:
    """Count, discount and normalise; ``learn`` is a column that marks the rows to learn from, ``least`` the
    count from which a bigram is kept."""
    spark = docs.sparkSession
    shared_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * parts
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col("text").cast("string")
    )
    name = f"fleetlens_blocks_{uuid.uuid4().hex}"
    cut = rows.mapInArrow(_cut(block_tokens), BLOCKS)
    cut.write.option("compression", "zstd").bucketBy(parts, "block").saveAsTable(name)
    blocks = spark.table(name)

    def totals(requests, least: int, name: str) -> DataFrame:
        schema = "block long, bucket long, keys array<long>, v0 array<long>"
        return keep(blocks.mapInArrow(requests, schema).groupBy("bucket").applyInArrow(_add_up(least), REPLY), name)

    words = totals(_word_requests(buckets), 1, "words")
    *sizes, tokens = _sizes(words)
    unigrams = Unigrams.of(np.array(sizes), int(tokens))
    pairs = totals(_pair_requests(buckets), least, "pairs")
    scale = discounts(_sizes(pairs)[:-1])
    texts = rows.where("learn").count()
    model = KatzModel(blocks, words, pairs, pairs, unigrams, scale, texts, buckets)
    asked = (
        blocks.groupBy("block")
        .cogroup(model.replies("word", "pair").groupBy("to"))
        .applyInArrow(
            _history_requests(buckets, unigrams, scale),
            "block long, bucket long, keys array<long>, v0 array<double>, v1 array<double>",
        )
    )
    model.histories = keep(asked.groupBy("bucket").applyInArrow(_add_histories, REPLY), "histories")
    return model


def katz_query(docs: DataFrame) -> DataFrame:
    model = build(docs, remainder("doc_id", 5) != 1, least=1)
    held_out = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False)).alias("held_out")
    return model.scores().select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
