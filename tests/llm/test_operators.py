"""Operators without SQL against brute force, held-out accuracy, and odd input."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlens.llm import (
    chat,
    decontaminate,
    host_trust,
    katz,
    language,
    licences,
    mixing,
    near_vectors,
    ngram_join,
    queries,
    subword,
)
from fleetlens.llm import links as links_module
from fleetlens.llm import text as tx
from fleetlens.llm.links import components
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, " \n "), (None, "alpha beta gamma"), (5, "alpha beta gamma"), (5, "alpha beta gamma")]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_against_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF), con, queries.SQL[name]) == ""


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def fold(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# ---- words


def test_words_match_a_regular_expression():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aB1é \n\t.-ß\x00日") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += [None, "", "x" * (tx.SLICE * 2 + 5) + " y", "ab cd " * (tx.SLICE // 4)]
    for table, pattern in ((tx.NON_BLANK, r"[^\x20\x09-\x0D]+"), (tx.WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        counts, found = [], []
        for _, n, h in tx.words(pa.array(texts, pa.string()), table):
            counts += list(n)
            found += list(h)
        words = [re.findall(pattern, fold(t)) for t in texts]
        assert counts == [len(w) for w in words]
        flat = [w for own in words for w in own]
        seen: dict = {}
        assert all(seen.setdefault(w, h) == h for w, h in zip(flat, found))
        assert len(set(seen.values())) == len(seen)


# ---- 1


def test_decontamination_proximity_and_odd_rows(spark):
    item = " ".join(f"w{i}" for i in range(13))
    moved = item.replace("w6", "x w6")
    docs = docs_of(spark, [*ODD, (10, item.upper()), (11, moved), (12, f"{item} " * 3)])
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "beta gamma")], "item_id long, text string")
    rows = decontaminate.decontaminate(docs, items).collect()
    assert len(rows) == 9
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and not by[1].contaminated
    assert by[5]["items"] == ["10"] and by[5].n_hit == 2 and by[5].contaminated
    assert by[10]["items"] == ["7"] and by[10].n_hit == 13
    assert by[11].n_hit == 0 and by[11].n_near >= 1
    assert by[12].n_hit == 39
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert not [r for r in decontaminate.decontaminate(docs, items.limit(0)).collect() if r.contaminated]


# ---- 2


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


@pytest.mark.parametrize("size,percent,block", [(3, 90, 1024), (5, 80, 4), (3, 90, 4)])
def test_ngram_join_against_all_pairs(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(size + percent)
    rows, number = [], 0
    for _ in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.choice([2, 4, 12, 60, 150]))]
        for _ in range(rng.randrange(1, 12)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = "z" + str(rng.randrange(5))
            rows.append((number, " ".join(own)))
            number += 1
    rows += [(number, ""), (number + 1, None)]
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    want = sorted((i, len(sets[i]), top(i)) for i in sets)
    got = ngram_join.ngram_join(docs_of(spark, rows), size, percent)
    assert sorted(map(tuple, got.collect())) == want


def test_ngram_join_compares_few_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    # most copies differ from the base in two words, so that two of them lie just under the similarity
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    monkeypatch.setattr(ngram_join, "SHARE", 256)
    rng, rows = random.Random(4), []
    for number in range(300):
        own = [f"w{i}" for i in range(150)]
        for at in rng.sample(range(150), 1 if number % 50 == 7 else 2):
            own[at] = f"x{rng.randrange(10**9)}"
        rows.append((number, " ".join(own)))
    compared, verified = [], ngram_join.verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(ngram_join, "verified", counted)
    got = dict((r.doc_id, r.component_id) for r in ngram_join.ngram_join(docs_of(spark, rows), 5, 80).collect())
    sets, root = {i: shingles(t, 5) for i, t in rows}, {i: i for i, _ in rows}
    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert got == root
    assert sum(compared) < 10 * len(rows)


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(9)
    for n in (1, 3, 40, 146, 700, 3000, 9000):
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        extra = rng.integers(0, 1 << 63, n // 4 + 2, dtype=np.uint64)
        a, b = np.concatenate([common, extra[: len(extra) // 2]]), np.concatenate([common, extra[len(extra) // 2 :]])
        found = int(ngram_join._distance(*(pa.array([ngram_join.sketch(x)]) for x in (a, b)))[0])
        assert 0.75 * len(extra) <= found <= len(extra)


def test_each_component_keeps_its_nearest_pair():
    # a, b, root of either, distance
    found = np.array([[1, 5, 10, 30, 4], [2, 6, 10, 30, 3], [2, 7, 10, 40, 3], [3, 7, 20, 40, 9], [1, 8, 10, 50, 7]]).T
    kept = {tuple(x[:2]) for x in ngram_join._nearest(found).T.tolist()}
    assert kept == {(2, 6), (2, 7), (3, 7), (1, 8)}


def test_ngram_join_odd_rows(spark):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs_of(spark, ODD)).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5)} <= rows
    assert ngram_join.ngram_join(docs_of(spark, ODD).limit(0)).count() == 0


def test_ngram_join_links_through_rows_without_an_id(spark):
    words = [f"w{i}" for i in range(40)]
    chain = [" ".join(words), " ".join([*words[1:], "x"]), " ".join([*words[2:], "x", "y"])]
    rows = [(1, chain[0]), (None, chain[1]), (3, chain[2]), (None, "all alone here"), (None, ""), (9, "z")]
    docs = docs_of(spark, rows).withColumns({"key": F.lit("k"), "mark": F.lit("m"), "n_shingles": F.lit(1)})
    got = sorted((tuple(r) for r in ngram_join.ngram_join(docs).collect()), key=repr)
    assert got == sorted([(1, 38, 1), (None, 38, 1), (3, 38, 1), (None, 1, None), (None, 0, None), (9, 1, 9)], key=repr)


@pytest.mark.parametrize("percent", [70, 80, 90, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    ends = ngram_join.bands(percent, 1 << 40)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        most = 2 * n * (100 - percent) // (percent * 2)
        extra = int(rng.integers(0, most + 1))
        left, right = np.split(rng.integers(0, 1 << 63, extra, dtype=np.uint64), [int(rng.integers(0, extra + 1))])
        a, b = np.unique(np.concatenate([common, left])), np.unique(np.concatenate([common, right]))
        if 100 * n >= percent * (n + extra):
            found = [set(ngram_join.signatures(x, percent, ends).tolist()) for x in (a, b)]
            assert found[0] & found[1]


def test_ngram_join_deals_equal_texts_over_all_buckets():
    for ids, texts in (([7] * 3200, ["a b c d e"] * 3200), ([None] * 3200, [None] * 3200), (range(3200), [""] * 3200)):
        columns = [pa.array(ids, pa.int64()), pa.array([5] * 3200, pa.int64()), pa.array(texts, pa.string())]
        batch = pa.record_batch(columns, names=["doc_id", "mark", "text"])
        out = pa.Table.from_batches(ngram_join._sign(3, 90, 32)(iter([batch.slice(0, 1000), batch.slice(1000)])))
        rows = out.filter(pa.compute.is_null(out["settled"]))
        assert len(rows) == 3200 and max(Counter(rows["bucket"].to_pylist()).values()) < 200


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def _tasks(spark, job):
    """The tasks that a job's stages ran, and its result."""
    group = f"tasks-{random.random()}"
    spark.sparkContext.setJobGroup(group, "tasks")
    try:
        result = job()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for s in stages if (i := status.getStageInfo(s))), result


def test_components_of_few_links_take_few_tasks(spark, monkeypatch):
    # a forest of every task's links, then one of these: nothing is dealt out over all partitions, round by round
    links = [(i + 1, i) for i in range(500)] + [(1000, i) for i in range(1001, 1300)] + [(None, 5), (9, None), (2000, 2000)]
    want = {i: 0 for i in range(501)} | {i: 1000 for i in range(1000, 1300)}
    pairs = spark.createDataFrame(links, "a long, b long").repartition(16)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 64)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tasks, got = _tasks(spark, lambda: components(pairs).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == sorted(want.items())
    assert 0 < tasks <= 100
    # more links than a task takes: rounds of all tasks, with the same components
    monkeypatch.setattr(links_module, "LINKS", 100)
    assert sorted(map(tuple, components(pairs).collect())) == sorted(want.items())


# ---- 3, 4, 5


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.language_query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_language_codes_and_odd_rows(spark):
    for n in (2, 3, 4, 6, 9):
        code = language.codewords(n)
        assert len({tuple(c) for c in code}) == n and set(np.unique(code)) <= {-1, 1}
    docs = docs_of(spark, [*ODD, (20, "12 3!")]).withColumn("score", F.lit("mine"))
    rows = language.identify(docs, language.learn(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in rows}[20] == "und" and len(rows) == 7
    assert [r.score for r in rows if r.doc_id in (1, 2, 3)] == [0.0] * 3
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.limit(0), None).count() == 0


def test_quality_held_out_and_odd_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    found = subword.quality_query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in found if r.quality == 1]
    bad = [r for r in found if r.quality == 0]
    assert np.mean([r.predicted for r in good]) > 0.97 and np.mean([r.predicted for r in bad]) < 0.3
    odd = docs_of(spark, ODD)
    scored = subword.quality_query(odd, labels.limit(0)).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    assert subword.quality_query(odd.limit(0), labels).count() == 0


def test_mixing_meets_targets(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = mixing.learn_domains(docs, labels)
    rows = mixing.mix(docs.select("doc_id", "text"), model).collect()
    tokens = np.array([r.n_tokens for r in rows], float)
    shares = np.array([r.posteriors for r in rows])
    rates = np.array([r.rate for r in rows])
    assert (rates >= 0).all() and len(rows) == docs.count()
    reached = (rates * tokens) @ shares / tokens.sum()
    assert np.abs(reached - [mixing.TARGETS[c] for c in model.classes]).max() < 0.01
    assert mixing.mix(docs_of(spark, ODD), model).count() == 6
    assert mixing.mix(docs.limit(0), model).count() == 0


# ---- 6


def brute_cost(roles):
    """Cheapest repair by trying every way."""
    best = {3: 0}
    for role in roles:
        after = defaultdict(lambda: math.inf)
        for state, cost in best.items():
            for to in range(3):
                change = 0 if role == to else 2
                if to == state:
                    after[to] = min(after[to], cost + change + 1)
                if to in chat.NEXT[state]:
                    after[to] = min(after[to], cost + change)
                elif any(to in chat.NEXT[p] for p in chat.NEXT[state]):
                    after[to] = min(after[to], cost + change + 3)
        best = after
    return min(c + {1: 0, 0: 3, 2: 6, 3: 0}[s] for s, c in best.items())


def test_chat_repairs_are_cheapest_in_any_chunking(spark):
    rng = random.Random(5)
    names = ["user", "assistant", "system", "tool", None]
    rows, want = [], {}
    for conv in range(40):
        roles = [rng.choice(names) for _ in range(rng.randrange(1, 14))]
        rows += [(conv, t, r, f"t{t} <|x") for t, r in enumerate(roles)]
        want[conv] = brute_cost([chat.role_number(r) for r in roles])
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for chunk in (3, 256):
        found = defaultdict(list)
        for r in chat.format_chats(turns, chunk).collect():
            found[r.conv_id].append(r)
        assert {c: sum(r.cost for r in own) for c, own in found.items()} == want
        for own in found.values():
            whole = "".join(r.piece for r in sorted(own, key=lambda r: r.turn))
            marks = re.findall(r"<\|(\w+)\|>", whole)
            assert re.fullmatch(r"(system end )?(user end assistant end )+", " ".join(marks) + " ")


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "USER", "b")]
    assert chat.format_chats(spark.createDataFrame(rows, schema)).count() == 4
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


# ---- 7


def test_url_rules_and_odd_rows(spark):
    pages = spark.createDataFrame(
        [
            (1, None, None),
            (2, "no scheme", ""),
            (3, "http://A.Example.ORG/es/1?x=://y", ""),
            (4, "http://b.org", '<a href="https://bad.com/">'),
            (5, "http://bad.com/de/1#f", ""),
            (6, "http://bad.com/en/", "<a href=//other.net/>"),
            (6, "http://bad.com/en/", ""),
            (7, "x://c.org/a#b", ""),
            (8, "http://friend.net/x", '<a href="http://bad.com/x">'),
        ],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r for r in host_trust.judge(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("", "", None, "allow")
    assert got[2].host == "" and got[4].path == "" and got[4].rule is None
    assert (got[3].host, got[3].path, got[3].rule, got[3].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[5].rule == "com/de/" and got[6].rule is None and got[6].verdict == "block"
    assert got[7].rule == "org/" and got[8].verdict == "block"
    assert host_trust.judge(pages.limit(0)).count() == 0


# ---- 8


@pytest.mark.parametrize("block", [1024, 7])
def test_near_vectors_recall_and_counts(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(60):
        base = rng.normal(size=48)
        for _ in range(rng.integers(1, 12)):
            noise = rng.choice([0.0, 0.08, 0.14, 0.3])
            v = (base + noise * rng.normal(size=48)).astype(np.float32)
            rows.append((len(rows), [float(x) for x in v], int(rng.integers(0, 2))))
    odd = [[0.0] * 48, None, [float("nan")] + [1.0] * 47, [None] + [1.0] * 47]
    rows += [(len(rows) + i, v, 0) for i, v in enumerate(odd)] + [(len(rows) + 9, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in near_vectors.near_vectors(df).collect()}
    n = len(rows) - 5
    x = np.array([r[1] for r in rows[:n]])
    norm = np.sqrt((x * x).sum(1))
    near = (x @ x.T / np.outer(norm, norm) >= 0.98) & (
        np.array([r[2] for r in rows[:n]])[:, None] == np.array([r[2] for r in rows[:n]])
    )
    np.fill_diagonal(near, False)
    want = near.sum(1)
    found = np.array([got[i].n_links for i in range(n)])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum() > 0
    assert all(got[r[0]].n_links == 0 and got[r[0]].kept for r in rows[n:])
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


# ---- 9


def test_licence_odd_rows(spark):
    text = "x\nReleased under the MIT License!\nReleased under MIT a License"
    mit = licences.TEMPLATES["MIT-text"]
    rows = licences.scan(docs_of(spark, [*ODD, (8, text), (8, text), (9, "a\n\n" + mit.replace(" of ", "\nof "))])).collect()
    assert sorted((r.doc_id, r.part, r.place, r.licence) for r in rows) == [
        (8, "line", 1, "MIT"),
        (8, "line", 1, "MIT"),
        (9, "paragraph", 1, "MIT-text"),
    ]
    assert licences.scan(docs_of(spark, ODD).limit(0)).count() == 0


# ---- 10


def test_katz_against_a_plain_model(spark):
    rng = random.Random(9)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    rows += [(500, None), (None, "w1 w2 never")]
    docs = docs_of(spark, rows)
    learn = (F.col("doc_id") % 5) != 1
    model = katz.build(docs, learn, block_tokens=300)
    got = {r.doc_id: r for r in model.scores().collect()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", fold(t)), "</s>"] for i, t in rows}
    known = [i for i in tokens if i is not None and i % 5 != 1]
    uni = Counter(w for i in known for w in tokens[i])
    bi = Counter(p for i in known for p in zip(["<s>", *tokens[i]], tokens[i]))
    history = Counter(h for i in known for h in ["<s>", *tokens[i]][:-1])
    total = sum(uni.values())
    level = katz.Unigrams.of(np.array([sum(c == r for c in uni.values()) for r in range(1, 7)] + [0]), total)
    scale = katz.discounts(np.array([sum(c == r for c in bi.values()) for r in range(1, 7)] + [0]))
    p1 = lambda w: float(level.probability(np.array([uni[w]]))[0])
    kept = defaultdict(dict)
    for (h, w), c in bi.items():
        if c >= 2:
            kept[h][w] = scale[min(c, 6)] * c
    alpha, denominator = {}, {}
    for h, own in kept.items():
        mass = sum(own.values())
        denominator[h] = history[h] if history[h] - mass > 1e-9 * history[h] else history[h] + 1
        alpha[h] = (1 - mass / denominator[h]) / (1 - sum(map(p1, own)))
        sums = sum(c / denominator[h] for c in own.values())
        rest = alpha[h] * (sum(p1(w) for w in uni if w not in own) + level.unknown)
        assert abs(sums + rest - 1) < 1e-9
    for i, own in tokens.items():
        score = 0.0
        for h, w in zip(["<s>", *own], own):
            direct = kept.get(h, {}).get(w)
            score += math.log10(direct / denominator[h] if direct else alpha.get(h, 1.0) * p1(w))
        assert got[i].score == pytest.approx(score, abs=1e-7)
        assert got[i].n_tokens == len(own) and got[i].n_known == sum(uni[w] > 0 for w in own)
        base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (len(uni) + 1))) for w in own)
        assert got[i].base_score == pytest.approx(base, abs=1e-7) and got[i].train_tokens == total
    assert katz.katz_query(docs.limit(0)).count() == 0
    assert {r.score for r in katz.build(docs, F.lit(False)).scores().collect()} == {0.0}


def test_katz_query_keeps_bigrams_seen_once(spark):
    rng = random.Random(5)
    word = lambda: f"w{min(int(rng.paretovariate(1.1)), 400)}"
    rows = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(120)]
    rows += [(501, "never seen"), (None, "w1 w2 never")]
    got = {r.doc_id: r for r in katz.katz_query(docs_of(spark, rows)).collect()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", fold(t)), "</s>"] for i, t in rows}
    held_out = [i for i in tokens if i is not None and zlib.crc32(str(i).encode()) % 5 == 1]
    known = [i for i in tokens if i is not None and i not in held_out]
    uni = Counter(w for i in known for w in tokens[i])
    bi = Counter(p for i in known for p in zip(["<s>", *tokens[i]], tokens[i]))
    history = Counter(h for i in known for h in ["<s>", *tokens[i]][:-1])
    sizes = lambda counts: np.array([sum(c == r for c in counts.values()) for r in range(1, 7)] + [0])
    level, scale = katz.Unigrams.of(sizes(uni), sum(uni.values())), katz.discounts(sizes(bi))
    assert 0 < scale[1] < 1
    p1 = lambda w: float(level.probability(np.array([uni[w]]))[0])
    kept = defaultdict(dict)
    for (h, w), c in bi.items():
        kept[h][w] = scale[min(c, 6)] * c

    def chance(h, w):
        own = kept.get(h, {})
        whole = history[h] if history[h] - sum(own.values()) > 1e-9 * history[h] else history[h] + 1
        if w in own:
            return own[w] / whole
        return (1 - sum(own.values()) / whole) / (1 - sum(map(p1, own))) * p1(w) if own else p1(w)

    once = 0
    for i, own in tokens.items():
        pairs = list(zip(["<s>", *own], own))
        once += sum(bi[p] == 1 for p in pairs) if i in held_out else 0
        assert got[i].score == pytest.approx(sum(math.log10(chance(*p)) for p in pairs), abs=1e-7)
    assert once > 10
    for h in ["<s>", *list(uni)[:20]]:
        assert sum(chance(h, w) for w in [*uni, "unknown"]) == pytest.approx(1, abs=1e-9)


# ---- pipeline


def test_pipeline_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs_of(spark, [(None, None), (90001, "12 34"), (90002, "")]).union(docs.limit(1))
    docs = docs.unionByName(extra)
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).checkpoint())
    columns = docs.columns
    assert all(f.columns == columns for f in frames[:-1])
    assert frames[-1].columns[:5] == columns and {"rate", "copies", "domain"} <= set(frames[-1].columns)
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    assert not {90001, 90002, None} & set(ids[1]) and len(ids[1]) >= len(ids[0]) - 4
    groups = ngram_join.ngram_join(frames[2], 5, 80).collect()
    assert set(ids[3]) == {r.component_id for r in groups}
    bad = {r.doc_id for r in decontaminate.decontaminate(frames[3], spark.read.parquet(f"{SF}/benchmark.parquet")).collect() if r.contaminated}
    assert set(ids[4]) == set(ids[3]) - bad and sorted(ids[5]) == sorted(ids[4])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_judges_rows_with_null_and_repeated_ids(spark):
    words = [f"v{i}" for i in range(100)]
    link = [*words[:92], *(f"x{i}" for i in range(8))]
    far = [*(f"y{i}" for i in range(8)), *link[8:]]
    other, copied = (" ".join(f"{c}{i}" for i in range(30)) for c in "pq")
    rows = [(4, " ".join(far)), (None, " ".join(link)), (3, " ".join(words)), (None, copied), (None, copied)]
    rows += [(8, copied + " q30"), (8, other), (9, other), (9, other), (10, ""), (10, "")]
    got = corpus_pipeline.one_of_each_group(spark, docs_of(spark, rows), SF).collect()
    want = [(3, " ".join(words)), (8, copied + " q30"), (8, other), (10, ""), (10, "")]
    assert sorted((r.doc_id, r.text) for r in got) == sorted(want)
    nameless = corpus_pipeline.one_of_each_group(spark, docs_of(spark, [(None, copied)] * 3), SF).collect()
    assert [(r.doc_id, r.text) for r in nameless] == [(None, copied)]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(1).collect()
    bad = items[0].text
    got = corpus_pipeline.uncontaminated(spark, docs_of(spark, [(None, bad), (7, bad), (7, other), (None, other)]), SF)
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(7, other), (None, other)]))


CLASHES = ["score", "n_tokens", "posteriors", "lang_pred", "predicted", "ambiguous", "_row", "_gone", "_doc", "domain", "rate", "copies"]
CLASHES += ["component_id", "n_shingles", "contaminated", "key", "mark", "label", "a.b"]


def test_pipeline_stages_keep_columns_of_any_name_and_long_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    long = docs_of(spark, [(5001, " ".join(f"word{i % 977} and{i}" for i in range(120_000)))])  # over two megabytes
    docs = docs.unionByName(long.withColumn("lang", F.lit("en")))
    for c in CLASHES:
        docs = docs.withColumn(c, F.concat(F.lit("mine "), F.col("doc_id").cast("string")))
    given = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        last = name == corpus_pipeline.STAGES[-1][0]
        names = [f"{c}_input" if last and c in corpus_pipeline.ADDED else c for c in docs.columns]
        assert out.columns == names + corpus_pipeline.ADDED * last
        rows = out.collect()
        assert len(rows) >= 20
        for r in rows:
            assert tuple(r)[: len(names)] == tuple(given[r.doc_id])
    assert 5001 in {r.doc_id for r in rows}


def test_labelled_rows_are_bounded_however_often_an_id_is_repeated(spark):
    docs = docs_of(spark, [(7, f"text {i}") for i in range(500)] + [(8, "b")])
    labels = spark.createDataFrame([(7, "0"), (8, "1")], "doc_id long, label string")
    assert subword.sample_labelled(docs, labels, 100).count() == 100
    assert subword.sample_labelled(docs, labels, 1000).count() == 501
