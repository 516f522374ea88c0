"""Spelling variants: words one letter apart, found in a reduced alphabet and verified on the words themselves.

Letters are hashed to a few symbols. Two words one edit apart have reduced words that are equal or one edit
apart, so every word generates the one-edit neighbourhood of its reduced word and joins the reduced
vocabulary; Spark's ``levenshtein`` then decides on the original words. Of a pair of unequal length the longer
word generates (deletions reach the shorter), of a pair of equal length the one with the smaller symbol where
they differ, so each pair is generated once and none is lost.

Defined results: a null text has no words; a null doc_id counts as empty text in the hash; a table without
words gives no rows; equal counts are settled by code-point order; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.store import keep
from fleetlens.llm.text import mix, utf8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of every run of these letters a word is made; only A-Z are lower-cased.
RUN = "[a-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO, DAMAGE = 5, 3, 2, 97
#: Letters handled at once when neighbourhoods are generated.
LETTERS = 1 << 15
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, or where ``DAMAGE`` divides the crc32 h of ``doc_id:run``, without its code point h % length."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(F.pmod(h, F.lit(DAMAGE)) == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points seen at least ``min_count`` times in all texts."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))
    rows = docs.select("doc_id", F.explode(runs).alias("run"))
    words = rows.select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def symbol_count(words: int) -> int:
    """Symbols of the reduced alphabet: enough for six letters to tell the words apart, 4 at least."""
    return max(4, math.ceil(max(words, 1) ** (1 / 6)))


def _symbols(symbols: int) -> np.ndarray:
    """Symbol of each byte that stands for a letter (the lead byte of two-byte letters is left out). Remainders
    give every symbol as many letters as the next."""
    return np.arange(256) % symbols


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte per letter of all words, and where each word begins (one more for the end)."""
    raw, bounds = utf8(column)
    letter = raw != 0xC3
    begins = np.concatenate([[0], np.cumsum(letter)])[bounds]
    return raw[letter], begins


def _reduced(symbols: int, neighbours: bool):
    """(id, key, own) of each word: the reduced word itself and, if asked for, its one-edit neighbours."""
    table = _symbols(symbols)
    value = mix(np.arange(1, symbols + 1, dtype=np.uint64) * _BASE)

    def rows(ids: np.ndarray, key: np.ndarray, own: bool) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(key.view(np.int64), pa.int64()), pa.array(np.full(len(ids), own))],
            names=["id", "key", "own"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            letters, begins = _flat(batch.column("word"))
            code, lengths = table[letters], np.diff(begins)
            if not len(code):
                continue
            power = np.full(int(lengths.max()) + 1, _BASE, np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            word = np.repeat(np.arange(len(ids)), lengths)
            place = np.arange(len(code)) - begins[word]
            sums = np.zeros(len(code) + 1, np.uint64)
            np.cumsum(value[code] * power[place], out=sums[1:])
            whole = sums[begins[1:]] - sums[begins[:-1]]
            size = lengths.astype(np.uint64) * _LENGTH
            yield rows(ids, mix(whole + size), True)
            if not neighbours:
                continue
            for a in range(0, len(code), LETTERS):
                z = slice(a, min(a + LETTERS, len(code)))
                w, c, p = word[z], code[z], place[z]
                # one deletion for each run of equal symbols
                lead = p == 0
                lead[1:] |= c[1:] != c[:-1]
                if a and not lead[0]:
                    lead[0] = code[a - 1] != c[0]
                i, u = np.arange(z.start, z.stop)[lead], w[lead]
                before = sums[i] - sums[begins[u]]
                after = sums[begins[u + 1]] - sums[i + 1]
                yield rows(ids[u], mix(before + after * _INVERSE + size[u] - _LENGTH), False)
                for s in range(1, symbols):
                    less = c < s
                    u = w[less]
                    key = whole[u] + (value[s] - value[c[less]]) * power[p[less]] + size[u]
                    yield rows(ids[u], mix(key), False)

    return run


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(id, other) once for each two of ``words`` (id, word; both unique) that are exactly one edit apart."""
    symbols = symbols or symbol_count(words.count())
    coded = words.select("id", "word")
    made = "id long, key long, own boolean"
    left = coded.mapInArrow(_reduced(symbols, True), made)
    right = coded.mapInArrow(_reduced(symbols, False), made).select(F.col("id").alias("other"), "key")
    pairs = left.join(right, "key").where("not own or id < other").select("id", "other")
    a = words.select("id", F.col("word").alias("a"))
    b = words.select(F.col("id").alias("other"), F.col("word").alias("b"))
    return pairs.join(a, "id").join(b, "other").where("levenshtein(a, b, 1) = 1").select("id", "other")


def chain_ends(steps: DataFrame, longest: int) -> DataFrame:
    """(id, root) of ``steps`` (id, to): the last word of each chain of at most ``longest`` steps, by doubling."""
    reach = steps.select("id", F.col("to").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(longest)) if longest else 0)):
        on = reach.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        reach = keep(
            reach.join(on, "root", "left").select("id", F.coalesce("beyond", "root").alias("root")), "chains"
        )
    return reach


def variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    symbols: int | None = None,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs`` (doc_id, text).

    ``form`` is the near word of largest count if that is at least ``ratio`` times the word's own, ``root`` the
    last word that following forms leads to (counts rise by ``ratio`` at each step, which bounds the chain).
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or chains of forms need not end")
    counts = vocabulary(docs, min_length, min_count)
    words = keep(counts.withColumn("id", F.monotonically_increasing_id()), "words")
    found = keep(near_words(words, symbols), "near")
    a = words.select("id", F.col("word").alias("a_word"), F.col("n").alias("a_n"))
    b = words.select(F.col("id").alias("other"), F.col("word").alias("b_word"), F.col("n").alias("b_n"))
    side = lambda own, w, n, i: F.struct(
        F.col(own).alias("id"), F.struct((-F.col(n)).alias("less"), F.col(w).alias("word"), F.col(i).alias("id")).alias("by")
    )
    both = F.array(side("id", "b_word", "b_n", "other"), side("other", "a_word", "a_n", "id"))
    sides = found.join(a, "id").join(b, "other").select(F.explode(both).alias("s")).select("s.id", "s.by")
    best = sides.groupBy("id").agg(F.count("*").alias("n_near"), F.min("by").alias("best"))
    judged = words.join(best, "id", "left").withColumn("form_n", -F.col("best.less"))
    larger = F.col("form_n") >= ratio * F.col("n")
    judged = keep(
        judged.select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(larger, F.col("best.word")).alias("form"),
            F.when(larger, F.col("best.id")).alias("to"),
            F.when(larger, F.col("form_n")).alias("form_n"),
        ),
        "judged",
    )
    most = judged.agg(F.max("n")).first()[0] or 1
    ends = chain_ends(judged.where("to is not null"), int(math.log(max(most, 1), ratio)) + 1)
    named = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    named = named.select("id", "root_word")
    out = judged.join(named, "id", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root"))
