"""Repeats, token alignment and spelling variants against brute force, and odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import queries, repeats, spelling, token_alignment

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside; in the input they are only further columns.
CLASHING = "id long, mark string, runs string, word string, n string, pair string, chunk string, kind string, key long"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def with_clashes(docs):
    for column in CLASHING.split(", "):
        name, kind = column.split()
        docs = docs.withColumn(name, F.lit("7").cast(kind))
    return docs


# ---- 11


def plain_repeats(rows, length):
    """Sorted (doc_id, bytes, spans, kept) by looking every string up."""
    rank = lambda i: repeats.LAST if i is None else i
    least = {}
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            least[s] = min(rank(i), least.get(s, repeats.LAST))
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            if least[raw[p : p + length]] < rank(i):
                gone[p : p + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]).astype(int)))
        spans = [(int(s), int(e)) for s, e in zip(edge[::2], edge[1::2])]
        out.append((i, len(raw), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=repr)


def found_repeats(docs, length):
    rows = repeats.remove_repeats(docs, length).collect()
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows), key=repr)


def shared_texts(seed, letters, size=140):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [word(rng.randrange(20, 200)) for _ in range(8)]
    rows = []
    for i in range(size):
        text = "".join(rng.choice([word(rng.randrange(60)), rng.choice(passages)]) for _ in range(rng.randrange(6)))
        rows.append((rng.choice([None, i % 50, i]), rng.choice([text, text, None if i % 9 else text])))
    rows += [(900, "ab" * 300), (901, "ab" * 290 + "c"), (902, "a" * 500), (902, "a" * 500), (903, "a" * 49)]
    rows += [(904, rows[0][1]), (905, ""), (None, "a" * 500), (906, "éa日" * 90), (907, "x" + "éa日" * 80)]
    return rows


@pytest.mark.parametrize("length,letters", [(50, "abcdefghij é日\x00"), (16, "ab"), (23, "abc ")])
def test_repeats_against_every_string(spark, length, letters):
    rows = shared_texts(length, letters)
    assert found_repeats(with_clashes(docs_of(spark, rows)).repartition(5), length) == plain_repeats(rows, length)


def test_repeats_of_a_hot_passage_long_texts_and_no_rows(spark):
    rng = random.Random(5)
    passage = "the same words stand in every third of these texts and they are long enough to be found"
    rows = [(i, f"{rng.random()} {passage if i % 3 == 0 else i} {rng.random()}") for i in range(600)]
    long = " ".join(str(rng.random()) for _ in range(60_000))  # more than a megabyte
    rows += [(-1, long), (700, long[1000:] + "x"), (701, "")]
    got = {r[0]: r for r in found_repeats(docs_of(spark, rows), 50)}
    for i in range(3, 600, 3):
        (start, stop), = got[i][2]
        assert passage.encode() in rows[i][1].encode()[start:stop] and stop - start <= len(passage) + 12
    assert not got[0][2] and not got[1][2] and not got[-1][2]
    assert got[700][2] == [(0, len(long) - 1000)] and got[700][3] == b"x"
    assert found_repeats(docs_of(spark, []), 50) == []


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(200):
        raw = bytes(rng.choice(b"ab\x00"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(120)))
        order, rank = repeats.suffix_array(np.frombuffer(raw, np.uint8))
        plain = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert order.tolist() == plain and all(rank[p] == k for k, p in enumerate(plain))
        cap, shared = rng.randrange(1, 60), []
        for k, p in enumerate(plain):
            n, q = 0, plain[k - 1]
            while k and n < cap and max(p, q) + n < len(raw) and raw[p + n] == raw[q + n]:
                n += 1
            shared.append(n)
        assert repeats.common_prefixes(np.frombuffer(raw, np.uint8), order, cap).tolist() == shared


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_shards_are_merged(parts):
    rng = random.Random(parts)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 60))).encode() for _ in range(60)]
    ids = np.array([rng.randrange(40) for _ in pieces])
    least = defaultdict(lambda: 10**9)
    for piece, i in zip(pieces, ids):
        for p in range(len(piece) - 7):
            least[piece[p : p + 8]] = min(least[piece[p : p + 8]], i)
    cut = np.array_split(np.arange(len(pieces)), parts)
    shards = [repeats.Shard([pieces[k] for k in own], ids[own], 8) for own in cut]
    repeats.merge(shards)
    for shard, own in zip(shards, cut):
        got = {(own[piece], s + k) for piece, s, n in shard.removed() for k in range(n)}
        want = {(j, p) for j in own for p in range(len(pieces[j]) - 7) if least[pieces[j][p : p + 8]] < ids[j]}
        assert got == want


# ---- 12


@pytest.fixture(scope="module")
def pair():
    return token_alignment.load(token_alignment.Tokenizers())


def plain_alignment(pair, rows):
    """Per row its figures, by comparing the byte ranges of all tokens."""
    held = []
    for _, text in rows:
        ids_a, ids_b = [], []
        if text:
            ids_a = pair.a.encode(" " + text, add_special_tokens=False).ids
            ids_b = pair.b.encode(text)
            raw = (" " + text).encode()
            if b"".join(pair.bytes_a[i] for i in ids_a) != raw or b"".join(pair.bytes_b[i] for i in ids_b) != raw:
                ids_a, ids_b = [], []
        spans = []
        for ids, size in ((ids_a, pair.bytes_a), (ids_b, pair.bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(size[i]), i))
                at += len(size[i])
            spans.append(own)
        a, b = spans
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, _, i in side if low <= s < e) for side in (a, b)))
            low = e
        links = [(i, j) for s, e, i in a for p, q, j in b if max(s, p) < min(e, q)]
        held.append((len(a), len(b), groups, links))
    count = Counter(link for *_, links in held for link in links)
    most = defaultdict(int)
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return sorted(
        (
            (
                i,
                n_a,
                n_b,
                len(groups),
                len(links),
                sum(count[x] == most[x[1]] for x in links),
                sum(count[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
            )
            for (i, _), (n_a, n_b, groups, links) in zip(rows, held)
        ),
        key=repr,
    )


def test_alignment_against_all_token_ranges(spark, pair):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).collect()]
    rows = [(i, t[:3000]) for i, t in rows]
    rows += [(1001, None), (1002, ""), (3, " "), (None, "one two"), (5, "one two"), (5, "one two"), (6, "<|endoftext|> </s> x")]
    rows += [(1007, "▁x"), (8, "日本 \U0001f600\x00\t\n  é"), (9, "  two  spaces "), (10, "aaaaaaaaaaaa" * 9), (11, "x y z")]
    docs = with_clashes(docs_of(spark, rows)).repartition(3)
    scored, table = token_alignment.align_tokens(docs)
    got = sorted((tuple(r) for r in scored.collect()), key=repr)
    assert got == plain_alignment(pair, rows)
    assert {r[0]: r[1] for r in got if r[0] in (1001, 1002, 1007)} == {1001: 0, 1002: 0, 1007: 0}
    assert table.agg(F.sum("n")).first()[0] == sum(r[4] for r in got)
    assert table.groupBy("a", "b").count().where("count > 1").count() == 0


def test_alignment_of_no_rows_and_a_long_text(spark, pair):
    assert token_alignment.align_tokens(docs_of(spark, []))[0].count() == 0
    text = "some words, again and again; " * 20_000
    row = token_alignment.align_tokens(docs_of(spark, [(1, text)]))[0].first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_a > 100_000


def test_both_encoders_of_the_file_agree(pair):
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{x}b {x} {x}{x}1{x}.{x}\n{x}  {x}'s{x}" for x in letters[:12_000] + rng.sample(letters, 8_000)]
    pool = rng.sample(letters, 300) + list(" \n\t'abcs1.,\u3000\u00a0\u200b\r") * 8
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(5_000)]
    assert pair.fast_a
    slow = [x.ids for x in pair.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert [pair.fast_a(t) for t in texts] == slow


def test_identity_map_joins_equal_bytes(pair):
    known = np.flatnonzero(pair.identity >= 0)
    assert len(known) > 1000
    assert all(pair.bytes_a[i] == pair.bytes_b[pair.identity[i]] for i in known)


# ---- 13


def plain_variants(rows):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                words[run] += 1
    words = {w: n for w, n in words.items() if n >= 3}

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("symbols", [None, 2, 13])
def test_variants_against_all_pairs(spark, symbols):
    rng = random.Random(7)
    bases = ["".join(rng.choice("abcdeéÿ÷") for _ in range(rng.randrange(5, 10))) for _ in range(12)]
    rows = []
    for i in range(400):
        own = []
        for _ in range(12):
            word = list(rng.choice(bases[: rng.choice([1, 3, 12])]))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(word))
                word[k : k + rng.choice([0, 1])] = rng.choice(["", "a", "é"])
            own.append("".join(word) if rng.random() < 0.8 else "".join(word).upper())
        rows.append((rng.choice([i, i, None]), rng.choice([" ", "-", "1"]).join(own)))
    rows += [(1, None), (2, ""), (3, "1 2 3"), (4, "abcde" * 3000 + " " + "abcde" * 3000 + "x"), (4, "abcde" * 3000)]
    rows += rows[-2:] * 2
    found = spelling.variants(with_clashes(docs_of(spark, rows)), symbols=symbols)
    got = sorted((tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)
    want = plain_variants(rows)
    assert got == want and any(r[2] != r[1] and r[1] for r in got) and max(len(r[0]) for r in got) > 10_000


def test_variants_of_no_words(spark):
    assert spelling.variants(docs_of(spark, [])).count() == 0
    assert spelling.variants(docs_of(spark, [(1, None), (2, "ab cd")])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(docs_of(spark, []), ratio=1)


def test_the_queries_are_registered():
    assert {"op11_repeats", "op12_token_alignment", "op13_spelling_variants"} <= set(queries.QUERIES)
