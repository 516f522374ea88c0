"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives every document a posterior over domains. Rates r >= 0
per document are then fitted so that the expected domain token totals, the sum of rate x tokens x
posterior, match targets, by distributed projected-gradient least squares from r = 1:

    minimise 1/2 (A r - t)' G^-1 (A r - t) over r >= 0,   A[d, i] = tokens_i * posterior_i[d] / all tokens

with G the Gram matrix of the domains, sum of tokens_i * posterior_i posterior_i' / all tokens: overlapping
or small domains are weighted so that one step solves the problem where no rate is clipped. The gradient is
scaled by tokens (a metric in which the projection is still a clip at 0), so a rate moves by the posterior
alone, whatever the document's length. Only the residual, one number a domain, travels
to the driver in each round; a document's rate follows from its posterior and the residuals so far, so no
state is rewritten and a lost executor costs nothing but its task.

Nulls, ties and odd rows: a null or blank text has no tokens and adds nothing to any total, but gets the
rate of its posterior; a null doc_id is kept; repeated rows count each time; equal posteriors name the
first domain; other columns pass through, and one named like a result column is replaced; an empty table
gives an empty result. A target whose domain no document can reach leaves a residual, nothing fails.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.store import keep
from fleetlens.llm.subword import SubwordModel, classify, fit, sample_labelled

#: Wanted shares of the expected tokens.
TARGETS = {"clean": 0.9, "low": 0.07, "toxic": 0.03}
ROUNDS, TOLERANCE = 60, 1e-4
FIT_ROWS = 4000


def learn_domains(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> SubwordModel:
    """Domain model of a bounded sample of labelled rows."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    labelled = labels.select("doc_id", domain.alias("label"))
    return fit(sample_labelled(docs, labelled, most), sorted(TARGETS))


def _rates(posteriors: np.ndarray, steps: list[np.ndarray], size: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given gradients, and the point at which the next gradient is taken."""
    rate = ahead = np.ones(len(posteriors))
    for k, residual in enumerate(steps):
        new = np.maximum(0.0, ahead - size * (posteriors @ residual))
        ahead = new + k / (k + 3) * (new - rate)
        rate = new
    return rate, ahead


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _totals(steps: list[np.ndarray], size: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_rate, at_ahead = np.zeros(width), np.zeros(width)
        for batch in batches:
            posteriors = _matrix(batch.column(1), width)
            tokens = batch.column(0).to_numpy()
            rate, ahead = _rates(posteriors, steps, size)
            at_rate += (rate * tokens) @ posteriors
            at_ahead += (ahead * tokens) @ posteriors
        yield pa.record_batch(
            [pa.array(np.arange(width)), pa.array(at_rate), pa.array(at_ahead)], names=["domain", "rate", "ahead"]
        )

    return run


def fit_rates(members: DataFrame, target: np.ndarray) -> tuple[list[np.ndarray], float, np.ndarray]:
    """Gradients, step size and final expected shares for rows (n_tokens, posteriors)."""
    width = len(target)
    pairs = [(i, j) for i in range(width) for j in range(width)]
    tokens = F.col("n_tokens").cast("double")
    sums = members.agg(
        F.sum(tokens).alias("all"),
        *(F.sum(tokens * F.col("posteriors")[i] * F.col("posteriors")[j]).alias(f"g{i}_{j}") for i, j in pairs),
    ).first()
    if not sums["all"]:
        return [], 0.0, np.zeros(width)
    gram = np.array([sums[f"g{i}_{j}"] for i, j in pairs]).reshape(width, width) / sums["all"]
    weight = np.linalg.pinv(gram + 1e-9 * np.eye(width), hermitian=True)
    size, steps = 1.0, []
    while True:
        rows = (
            members.select("n_tokens", "posteriors")
            .mapInArrow(_totals(steps, size, width), "domain long, rate double, ahead double")
            .groupBy("domain")
            .agg(F.sum("rate").alias("rate"), F.sum("ahead").alias("ahead"))
            .collect()
        )
        rows.sort(key=lambda r: r.domain)  # a row a class: sorted here, as a sort by Spark is two more stages a round
        reached = np.array([r.rate for r in rows]) / sums["all"]
        short = np.abs(reached - target).max()
        if len(steps) >= ROUNDS and short > TOLERANCE:
            warnings.warn(f"after {ROUNDS} rounds the shares are {reached.round(4)}, {short:.4f} from the target", stacklevel=2)
        if len(steps) >= ROUNDS or short <= TOLERANCE:
            return steps, size, reached
        # rounded, so that the order of a sum does not reach the results
        steps.append(np.round(weight @ (np.array([r.ahead for r in rows]) / sums["all"] - target), 9))


def _rated(steps: list[np.ndarray], size: float, width: int, names: list[str], place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            posteriors = _matrix(batch.column(place), width)
            rate, _ = _rates(posteriors, steps, size)
            best = [names[i] for i in posteriors.argmax(1)] if len(posteriors) else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(rate, pa.float64())],
                names=[*batch.schema.names, "domain", "rate"],
            )

    return run


def mix(docs: DataFrame, model: SubwordModel, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents with n_tokens, posteriors, domain, rate and copies.

    ``copies`` is the rate rounded down or up by chance (a hash of the id and text), so that its
    expectation is the rate.
    """
    targets = targets or TARGETS
    target = np.array([float(targets.get(name, 0.0)) for name in model.classes])
    docs = docs.drop("domain", "rate", "copies")
    members = classify(docs, model)
    slim = keep(members.select("n_tokens", "posteriors"), "members")
    steps, size, _ = fit_rates(slim, target)
    schema = T.StructType(
        [*members.schema.fields, T.StructField("domain", T.StringType()), T.StructField("rate", T.DoubleType())]
    )
    place = members.columns.index("posteriors")
    rated = members.mapInArrow(_rated(steps, size, len(target), model.classes, place), schema)
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    return rated.withColumn("copies", F.floor(F.col("rate") + chance))


def mixing_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, domain, posterior of that domain, rate and copies of every document."""
    mixed = mix(docs.select("doc_id", "text"), learn_domains(docs, labels))
    return mixed.select(
        "doc_id", "n_tokens", "domain", F.array_max("posteriors").alias("membership"), "rate", "copies"
    )
