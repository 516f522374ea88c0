"""Supervised subword embeddings: a document is the average of learned vectors of its hashed words and
character n-grams, classified by a softmax layer; vectors and layer are trained together by numpy
stochastic gradient descent.

Hashed features of a whole text: its words (A-Z folded), the sign that a word equals the one before it,
and its byte 3- and 4-grams as written. Words and n-grams weigh half each. The model is fitted on at most
``SAMPLE`` labelled rows, those with the smallest hash of their id, so the bound does not depend on the
order of rows; scoring covers every row and whole texts.

Nulls, ties and odd rows: a null text counts as empty and gets the score of the bias alone; labelled rows
with a null label, or without a text row, are not learned from; repeated rows count each time; other
columns pass through, and one named like a result column is replaced; with one class only, or without
labelled rows, every text gets that class's score 1, or equal shares; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm import text as tx
from fleetlens.llm.language import remainder
from fleetlens.llm.store import bound_batches, keep

BUCKETS, WIDTH = 1 << 14, 16
SAMPLE, EPOCHS, BATCH, RATE = 6000, 12, 64, 0.02
_ODD = np.uint32(0x9E3779B1)
_PIECE = 1 << 20


def _grams(raw: np.ndarray) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.float32)
    for at in range(0, len(raw), _PIECE):
        wide = raw[at : at + _PIECE + 3].astype(np.uint32)
        value = wide
        for n in (2, 3, 4):
            if len(wide) < n:
                break
            value = (value[:-1] << np.uint32(8)) | wide[n - 1 :]
            if n > 2:
                place = (value * _ODD + np.uint32(n)) * np.uint32(0x85EBCA6B)
                counts += np.bincount(place >> np.uint32(18), minlength=BUCKETS)
    return counts


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, int]]:
    """Of each text: feature shares (adding up to 1, or 0 for an empty text) and number of words."""
    raw, bounds = tx.utf8(column)
    row = 0
    for _, counts, found in tx.words(column, tx.NON_BLANK):
        place = (found >> np.uint64(50)).astype(np.int64)
        same = np.zeros(len(found), bool)
        same[1:] = found[1:] == found[:-1]
        at = 0
        for n in counts:
            n = int(n)
            own = np.bincount(place[at : at + n], minlength=BUCKETS).astype(np.float32)
            own[0] += same[at + 1 : at + n].sum()
            grams = _grams(raw[bounds[row] : bounds[row + 1]])
            yield own / max(2.0, 2 * own.sum()) + grams / max(2.0, 2 * grams.sum()), n
            at, row = at + n, row + 1


@dataclass
class SubwordModel:
    classes: list
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def posteriors(self, shares: np.ndarray) -> np.ndarray:
        logits = (shares @ self.vectors) @ self.layer + self.bias
        like = np.exp(logits - logits.max(1, keepdims=True))
        return (like / like.sum(1, keepdims=True)).astype(np.float64)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, values = [], []
        for share, _ in features(batch.column(0)):
            full = np.flatnonzero(share)
            places.append(full.astype(np.uint16).tobytes())
            values.append(share[full].astype(np.float16).tobytes())
        yield pa.record_batch(
            [batch.column(1), pa.array(places, pa.binary()), pa.array(values, pa.binary())],
            names=["label", "places", "values"],
        )


def sample_labelled(docs: DataFrame, labelled: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``most`` labelled rows (doc_id, label) by the hash of their id, however often an id is repeated."""
    chosen = labelled.where("doc_id is not null and label is not null")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    chosen = keep(chosen.select(F.col("doc_id").cast("long"), F.col("label").cast("string")), "chosen")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = texts.join(chosen, "doc_id")
    # an id may name many rows, so the bound is put on the rows too
    by = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("label"), F.xxhash64("text")]
    return found.orderBy(*by).limit(most).select("text", "label")


def fit(rows: DataFrame, classes: list[str] | None = None, epochs: int = EPOCHS) -> SubwordModel:
    """Fit on rows (text, label), whose number the caller bounds, in one task; only the model comes to the driver."""
    bound_batches(rows.sparkSession)
    sparse = rows.mapInArrow(_sparse, "label string, places binary, values binary").repartition(1)
    made = "classes array<string>, vectors binary, layer binary, bias binary"
    found = sparse.mapInArrow(_fitted(classes, epochs), made).collect()
    if not found:
        return _train([], [], [], classes, epochs)
    names, width = list(found[0].classes), max(1, len(found[0].classes))
    flat = lambda raw, *shape: np.frombuffer(raw, np.float32).reshape(shape)
    return SubwordModel(
        names, flat(found[0].vectors, BUCKETS, WIDTH), flat(found[0].layer, WIDTH, width), flat(found[0].bias, width)
    )


def _fitted(classes: list[str] | None, epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, places, values = [], [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            places += batch.column(1).to_pylist()
            values += batch.column(2).to_pylist()
        if not labels:
            return
        model = _train(labels, places, values, classes, epochs)
        arrays = [pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (model.vectors, model.layer, model.bias)]
        yield pa.record_batch(
            [pa.array([model.classes], pa.list_(pa.string())), *arrays], names=["classes", "vectors", "layer", "bias"]
        )

    return run


def _train(labels: list, places: list, values: list, classes: list[str] | None, epochs: int) -> SubwordModel:
    names = sorted(set(labels)) if classes is None else list(classes)
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.1, (WIDTH, max(1, len(names)))).astype(np.float32)
    bias = np.zeros(max(1, len(names)), np.float32)
    if not labels or len(names) < 2:
        return SubwordModel(names, vectors, layer * 0, bias)
    # rows come in any order: sort by content, then shuffle with a fixed seed, so that fits repeat
    order = np.array(sorted(range(len(labels)), key=lambda i: (labels[i], places[i], values[i])))
    target = np.array([names.index(x) for x in labels])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, layer, bias)]
    step = 0
    for _ in range(epochs):
        rng.shuffle(order)
        for lo in range(0, len(order), BATCH):
            own = order[lo : lo + BATCH]
            shares = np.zeros((len(own), BUCKETS), np.float32)
            for i, j in enumerate(own):
                shares[i, np.frombuffer(places[j], np.uint16)] = np.frombuffer(values[j], np.float16)
            hidden = shares @ vectors
            logits = hidden @ layer + bias
            like = np.exp(logits - logits.max(1, keepdims=True))
            like /= like.sum(1, keepdims=True)
            like[np.arange(len(own)), target[own]] -= 1
            like /= len(own)
            step += 1
            for p, g, (m, v) in zip(
                (vectors, layer, bias), (shares.T @ (like @ layer.T), hidden.T @ like, like.sum(0)), state
            ):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return SubwordModel(names, vectors, layer, bias)


def _apply(model: SubwordModel, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, words, held = [], [], []
            for share, n in features(batch.column(place)):
                held.append(share)
                words.append(n)
                if len(held) == 128:
                    found.append(model.posteriors(np.stack(held)))
                    held = []
            if held:
                found.append(model.posteriors(np.stack(held)))
            flat = np.concatenate(found).ravel() if found else np.empty(0)
            width = len(model.bias)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * width, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, pa.array(words, pa.int64())],
                names=[*batch.schema.names, "posteriors", "n_tokens"],
            )

    return run


def classify(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """The documents with posteriors (in the order of ``model.classes``) and n_tokens."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("posteriors", "n_tokens").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("posteriors", T.ArrayType(T.DoubleType())),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    return docs.mapInArrow(_apply(model, docs.columns.index("text")), schema)


CUTOFF = 0.3


def learn_quality(docs: DataFrame, labels: DataFrame) -> SubwordModel:
    """Quality model of labelled rows that are not held out; classes '0' and '1'."""
    labelled = labels.where(remainder("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    return fit(sample_labelled(docs, labelled), ["0", "1"])


def score_quality(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """The documents with score and predicted."""
    docs = docs.drop("score", "predicted")
    scored = classify(docs, model).withColumn("score", F.col("posteriors")[1]).drop("posteriors", "n_tokens")
    return scored.withColumn("predicted", F.when(F.col("score") >= CUTOFF, 1).otherwise(0))


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs.select("doc_id", "text"), learn_quality(docs, labels))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")
