"""Language identification with error-correcting output codes.

Every language gets a codeword; one binary n-gram classifier per code bit separates the languages with
bit 1 from those with bit 0 (naive Bayes on hashed byte n-grams of the lower-cased letters, languages
weighted alike). A document's bit margins are compared with every codeword by a logistic loss, each bit
weighted by how well it separates the languages, and the nearest codeword wins. ``ambiguous`` marks a
document whose second codeword is almost as near.

Training counts cover all given rows and are summed by Spark; the model holds ``BUCKETS`` x bits numbers.

Nulls, ties and odd rows: a null text, or one without letters, is ``und`` with score 0; equal distances
go to the first language by name; rows without a language are not learned from; repeated rows count each
time; other columns pass through, and one named like a result column is replaced; with no language to
learn every text is ``und``; an empty table gives an empty result.
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
from fleetlens.llm.store import bound_batches

BUCKETS = 1 << 14
SIZES = (2, 3, 4)
#: Two codewords nearer than this to a document make it ambiguous.
MARGIN = 0.05
_ODD = np.uint32(0x9E3779B1)
_PIECE = 1 << 20

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def gram_counts(raw: np.ndarray) -> np.ndarray:
    """Hashed counts of the byte n-grams of one text; runs of non-letters count as one blank."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(raw), _PIECE):
        piece = raw[at : at + _PIECE + max(SIZES) - 1]
        own = _LETTER[piece]
        upper = np.flatnonzero((own[1:] >= 0x80) & (own[1:] < 0x9F) & (own[:-1] == 0xC3)) + 1
        own[upper] += 0x20  # É and é
        own = own[np.append(True, (own[1:] != 32) | (own[:-1] != 32))]
        wide = own.astype(np.uint32)
        value = wide
        for n in range(2, max(SIZES) + 1):
            if len(own) < n:
                break
            value = (value[:-1] << np.uint32(8)) | wide[n - 1 :]
            if n in SIZES:
                place = (value * _ODD + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
                counts += np.bincount(place >> np.uint32(18), minlength=BUCKETS)
    return counts


def has_letters(raw: np.ndarray) -> bool:
    if ((raw >= 97) & (raw < 123) | (raw >= 65) & (raw < 91)).any():
        return True
    return bool((raw >= 128).any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    raw, bounds = tx.utf8(column)
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield raw[a:b]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, raw in zip(batch.column(1).to_pylist(), _texts(batch.column(0))):
            if name not in total:
                total[name] = np.zeros(BUCKETS, np.int64)
            total[name] += gram_counts(raw)
    for name, counts in total.items():
        full = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array([name] * len(full), pa.string()), pa.array(full), pa.array(counts[full])],
            names=["lang", "bucket", "n"],
        )


def codewords(n: int) -> np.ndarray:
    """A row of +1/-1 per language: the exhaustive code for a few, a spread-out random one for many."""
    if n <= 6:
        bits = max(1, 2 ** (n - 1) - 1)
        code = np.ones((n, bits), int)
        for i in range(1, n):
            block = 2 ** (n - 1 - i)
            code[i] = [-1 if (j // block) % 2 == 0 else 1 for j in range(bits)]
        return code
    rng, best, apart = np.random.default_rng(17), None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]
        near = min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) if n < 60 else 1
        if near > apart:
            best, apart = code, near
    return best


@dataclass
class LanguageModel:
    names: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log odds of a gram
    trust: np.ndarray  # of each bit

    def distances(self, counts: np.ndarray) -> np.ndarray:
        """Weighted logistic loss to each codeword; counts is documents x buckets."""
        grams = np.maximum(counts.sum(1, keepdims=True), 1)
        margin = counts @ self.weights / np.sqrt(grams)
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None])
        return (loss * self.trust).sum(2)


def train(rows: DataFrame) -> LanguageModel | None:
    """Learn from all rows with a language (columns text, lang)."""
    bound_batches(rows.sparkSession)
    known = rows.where("lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = (
        known.mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("grams"))
        .orderBy("lang")
        .collect()
    )  # at most BUCKETS numbers a language
    if not counts:
        return None
    share = np.full((len(counts), BUCKETS), 0.5)
    for i, row in enumerate(counts):
        share[i, [g.bucket for g in row.grams]] += [g.n for g in row.grams]
    share /= share.sum(1, keepdims=True)
    code = codewords(len(counts))
    weights = np.empty((BUCKETS, code.shape[1]))
    for b in range(code.shape[1]):
        one, zero = share[code[:, b] > 0], share[code[:, b] < 0]
        flat = np.full((1, BUCKETS), 1 / BUCKETS)
        weights[:, b] = np.log(np.vstack([one, flat[: not len(one)]]).mean(0)) - np.log(
            np.vstack([zero, flat[: not len(zero)]]).mean(0)
        )
    reach = np.maximum((share @ weights * code).min(0), 1e-3)
    return LanguageModel([r.lang for r in counts], code, weights, reach / reach.sum())


def _predict(model: LanguageModel | None, place: int):
    def decide(column: pa.Array) -> tuple[list, list, list]:
        names, scores, unsure = [], [], []
        texts = list(_texts(column))
        for at in range(0, len(texts), 128):
            own = texts[at : at + 128]
            lettered = [bool(model) and has_letters(t) for t in own]
            if any(lettered):
                counts = np.stack([gram_counts(t) for t in own]).astype(np.float32)
                far = model.distances(counts)
                order = np.argsort(far, axis=1, kind="stable")
                best = order[:, 0]
                like = np.exp(far.min(1, keepdims=True) - far)
                sure = 1 / like.sum(1)
                two = np.sort(far, axis=1)[:, :2]
                close = (two[:, 1] - two[:, 0] < MARGIN) if far.shape[1] > 1 else np.zeros(len(own), bool)
            for i, ok in enumerate(lettered):
                names.append(model.names[best[i]] if ok else "und")
                scores.append(float(sure[i]) if ok else 0.0)
                unsure.append(bool(close[i]) if ok else False)
        return names, scores, unsure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, unsure = decide(batch.column(place))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "ambiguous"],
            )

    return run


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The documents with lang_pred, score and ambiguous."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "ambiguous").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    return docs.mapInArrow(_predict(model, docs.columns.index("text")), schema)


def remainder(column: str, of: int):
    """crc32 of an id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


def learn(docs: DataFrame) -> LanguageModel | None:
    """A model of the rows that are not held out."""
    return train(docs.where(remainder("doc_id", 4) != 2).select("text", "lang"))


def language_query(docs: DataFrame) -> DataFrame:
    own = docs.select("doc_id", "text")
    return identify(own, learn(docs)).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )

