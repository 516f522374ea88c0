"""Predictions of the classifiers and the mixing rates, computed again in plain Python from the fitted models."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import language, mixing, subword
from fleetlens.llm import text as tx

D = "/root/testdata/sf0.01"
MASK = (1 << 32) - 1
ODD = ["", "a", "É é ÉÉ", "12 3!", "one one one two", "naïve Straße 日本 日本"]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")


def some_texts(docs):
    rows = docs.where("doc_id % 25 = 0").select("text").collect()
    return [r.text for r in rows] + ODD


def asked(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def fold(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def plain_shares(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    own = Counter((tx.fingerprint(w) & ((1 << 64) - 1)) >> 50 for w in words)
    own[0] += sum(a == b for a, b in zip(words, words[1:]))
    raw, grams = text.encode(), Counter()
    for n in (3, 4):
        for i in range(len(raw) - n + 1):
            value = int.from_bytes(raw[i : i + n], "big")
            grams[((value * 0x9E3779B1 + n) & MASK) * 0x85EBCA6B % (1 << 32) >> 18] += 1
    out = Counter()
    for part in (own, grams):
        whole = max(2.0, 2.0 * sum(part.values()))
        for k, v in part.items():
            out[k] += v / whole
    return out


def plain_posterior(model, text):
    hidden = np.zeros(model.vectors.shape[1])
    for k, v in plain_shares(text).items():
        hidden += v * model.vectors[k].astype(float)
    logits = hidden @ model.layer.astype(float) + model.bias
    like = np.exp(logits - logits.max())
    return like / like.sum()


def test_quality_scores_again(spark, tables):
    docs, labels = tables
    model, texts = subword.learn_quality(docs, labels), some_texts(docs)
    got = {r.doc_id: r for r in subword.score_quality(asked(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        score = plain_posterior(model, text)[1]
        assert got[i].score == pytest.approx(score, abs=1e-4)
        assert got[i].predicted == int(got[i].score >= 0.3)


def plain_language(model, text):
    letters, before = [], None
    for b in text.encode():
        c = b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 128 else 32
        if before == 0xC3 and 0x80 <= c < 0x9F:
            c += 0x20
        before = b
        if c != 32 or not letters or letters[-1] != 32:
            letters.append(c)
    counts = Counter()
    for n in (2, 3, 4):
        for i in range(len(letters) - n + 1):
            value = int.from_bytes(bytes(letters[i : i + n]), "big")
            counts[((value * 0x9E3779B1 + n * 0x85EBCA6B) & MASK) * 0xC2B2AE35 % (1 << 32) >> 18] += 1
    margin = sum(n * model.weights[k] for k, n in counts.items()) / math.sqrt(max(sum(counts.values()), 1))
    margin = np.zeros(model.code.shape[1]) + margin
    return [(np.logaddexp(0, -margin * row) * model.trust).sum() for row in model.code]


def test_languages_again(spark, tables):
    docs, _ = tables
    model, texts = language.learn(docs), some_texts(docs)
    got = {r.doc_id: r for r in language.identify(asked(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        far = plain_language(model, text)
        if not any(c.isalpha() for c in text):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        assert got[i].lang_pred == model.names[int(np.argmin(far))]
        assert got[i].score == pytest.approx(1 / sum(math.exp(min(far) - f) for f in far), abs=1e-3)


def test_mixing_rates_again(spark, tables):
    docs, labels = tables
    model = mixing.learn_domains(docs, labels)
    rows = mixing.mix(docs.select("doc_id", "text"), model).collect()
    tokens, p = np.array([r.n_tokens for r in rows], float), np.array([r.posteriors for r in rows])
    for r in rows[::40]:
        text = next(iter([r.text]))
        assert r.posteriors == pytest.approx(plain_posterior(model, text).tolist(), abs=1e-4)
        assert r.domain == model.classes[int(np.argmax(r.posteriors))]
    target = np.array([mixing.TARGETS[c] for c in model.classes])
    weight = np.linalg.pinv((p * tokens[:, None]).T @ p / tokens.sum() + 1e-9 * np.eye(len(target)), hermitian=True)
    rate = ahead = np.ones(len(p))
    for k in range(mixing.ROUNDS):
        if np.abs((rate * tokens) @ p / tokens.sum() - target).max() <= mixing.TOLERANCE:
            break
        residual = weight @ ((ahead * tokens) @ p / tokens.sum() - target)
        new = np.maximum(0.0, ahead - p @ residual)
        rate, ahead = new, new + k / (k + 3) * (new - rate)
    assert [r.rate for r in rows] == pytest.approx(rate.tolist(), abs=1e-5)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)
