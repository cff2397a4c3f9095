"""Operators 11 to 13 against brute force, on odd rows and at odd sizes."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from pistil.llm import bisector, quality, runs
from pistil.llm.words import U64, mix
from tests.llm.helpers import ODD_TEXTS, documents, sentences

SPACE = r"[^\x20\x09-\x0D]+"


# --- 11: periodic runs -----------------------------------------------------------------------------------

def brute_runs(w, least=12):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def collapse(w, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def odd_sequences(seed):
    """Random, periodic, nested, Fibonacci and Thue-Morse sequences, and stretches of a small unit that meet."""
    rng = random.Random(seed)
    out = []
    for n in range(60):
        size = rng.randrange(500)
        kind = n % 6
        if kind == 0:
            out.append([rng.choice("ab"[:rng.randrange(1, 3)]) for _ in range(size)])
        elif kind == 1:
            unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 120))]
            out.append([unit[i % len(unit)] for i in range(size)])
        elif kind == 2:
            unit, w = [rng.choice("ab") for _ in range(rng.randrange(1, 8))], []
            for _ in range(rng.randrange(2, 10)):
                w += unit * rng.randrange(1, 40) + unit[:rng.randrange(len(unit) + 1)]
            out.append(w)
        elif kind == 3:
            a, b = "a", "ab"
            while len(b) < size:
                a, b = b, b + a
            out.append(list(b[:size]))
        elif kind == 4:
            out.append([str(bin(i).count("1") % 2) for i in range(size)])
        else:
            block = ["a"] * rng.randrange(1, 90) + ["b"] * rng.randrange(3)
            out.append(["c"] * rng.randrange(3) + block * rng.randrange(1, 6) + block[:rng.randrange(len(block))])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(seed):
    texts = odd_sequences(seed)
    number = {x: i for i, x in enumerate(sorted({x for w in texts for x in w}))}
    words = mix(np.array([number[x] for w in texts for x in w], dtype=np.uint64) + U64(9))
    got = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in runs.find(words, np.cumsum([0, *map(len, texts)])))):
        got[t].append(tuple(run))
    assert got == [brute_runs(w) for w in texts]


def test_periodic_runs_of_odd_texts(spark):
    texts = [*ODD_TEXTS, *[" ".join(w) for w in odd_sequences(7)[:24]], "A a " * 20, "  x　 " * 9, *sentences(1, 5)]
    rows = {r.id: r for r in runs.periodic_runs(documents(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        w = re.findall(SPACE, t or "")
        found = brute_runs(w)
        assert [tuple(r) for r in rows[i].runs] == found, t
        assert rows[i].collapsed == collapse(w, found)


def test_runs_of_a_long_text():
    """Half a million words: three repetitions of a third, inside it a stretch of one word."""
    rng = np.random.default_rng(3)
    unit = mix(rng.integers(0, 50_000, 160_000).astype(np.uint64))
    unit[1000:21_000] = unit[1000]
    words = np.concatenate([unit, unit, unit])
    found = list(zip(*(x.tolist() for x in runs.find(words, np.array([0, len(words)])))))
    assert (0, 0, 480_000, 160_000) in found
    assert {(s, n) for _, s, n, q in found if q == 1} >= {(1000, 20_000), (161_000, 20_000), (321_000, 20_000)}


def test_op11_contract(spark, tmp_path):
    texts = [*ODD_TEXTS, *sentences(4, 60, words=120)]
    documents(spark, texts, ids=[3 * i for i in range(len(texts))]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in runs.op11_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in enumerate(texts):
        w = re.findall(SPACE, t or "")
        n, (g, rest) = len(w), divmod(crc32(str(3 * i).encode()), 10)
        if rest == 0 and n:
            planted += 1
            a = g % n
            w = w[:a] + [w[a + (j - a) % (1 + (n - a) // (3 + g % 8))] for j in range(a, n)]
        found = brute_runs(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got[3 * i] == (len(found), *best, 1000 * best[1] // best[2] if found else None,
                              digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(collapse(w, found)))
    assert planted > 2


# --- 12: bisector tournament -----------------------------------------------------------------------------

def brute_clusters(rows, dims, k, rounds):
    """Plain Python integers; distances to all centroids."""
    kept = [(i, [math.floor(64 * x) if abs(x) < 1e15 else int(x) * 64 for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), n) for n, (i, _) in enumerate(kept) if i is not None)
    cent = [kept[n][1] for _, n in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent)) for _, v in kept]

    for _ in range(rounds):
        won = [j for _, j in assign()]
        for j in range(len(cent)):
            mine = [v for (_, v), w in zip(kept, won) if w == j]
            if mine:
                cent[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return {i: (j, d) for (i, _), (d, j) in zip(kept, assign())}, cent


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.02, 1.0, 1e7, 1e12])
def test_clusters_equal_brute_force(spark, spread):
    """Small components tie often; large ones need more than 64 bits."""
    rows = vectors(300, 8, 5, spread)
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "id long, vec array<double>, cluster int, n int").repartition(7)
    got, cent = bisector.cluster(df, "id", "vec", dims=8, k=6, rounds=3)
    want, centroids = brute_clusters(rows, 8, 6, 3)
    assert cent == centroids
    assert {r.id: (r.cluster, r.distance) for r in got.collect()} == {
        i: (j, d if d < 1 << 63 else None) for i, (j, d) in want.items()}


def test_clusters_of_odd_rows(spark):
    rows = vectors(40, 4, 2)
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, []), (104, [1.0, 2.0, 3.0]), (105, [1.0, None, 0.0, 0.0]),
             (106, [float("nan")] * 4), (107, [float("inf"), 0.0, 0.0, 0.0]), (108, [3e38, -3e38, 0.0, 1.0]), (109, [0.0] * 4)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got, cent = bisector.cluster(df, "id", "vec", dims=4, k=64, rounds=2)       # more centroids than vectors
    want, centroids = brute_clusters(rows, 4, 64, 2)
    assert cent == centroids and len(cent) == 44
    assert {r.id: (r.cluster, r.distance) for r in got.collect()} == {
        i: (j, d if d < 1 << 63 else None) for i, (j, d) in want.items()}
    full = {r.id: r for r in bisector.with_inertia(got, cent).collect()}
    assert len(full) == 44 and full[0].centroid_sha256 == bisector.centroid_digest(cent[full[0].cluster])


def test_clusters_without_rows_or_ids(spark):
    schema = "id long, vec array<float>"
    got, cent = bisector.cluster(spark.createDataFrame([], schema), "id", "vec", dims=2)
    assert cent == [] and bisector.with_inertia(got, cent).count() == 0
    got, cent = bisector.cluster(spark.createDataFrame([(None, [1.0, 2.0])], schema), "id", "vec", dims=2)
    assert [tuple(r)[:3] for r in bisector.with_inertia(got, cent).select("id", "cluster", "distance").collect()] == [(None, None, None)]


# --- 13: quality rules -----------------------------------------------------------------------------------

def brute_measures(text):
    text = text or ""
    w = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "n_letters": len(re.findall("[A-Za-z]", text)), "n_capitals": len(re.findall("[A-Z]", text)),
            "n_plain_words": sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", x)) for x in w)}


QUALITY_TEXTS = [*ODD_TEXTS, "a\na\n a\na \r\na\n\n\n", "one\n", "\none", "# $ % & | < > *", "A B C a b c A B C a b C",
                 "x y z " * 40, "1 2 3 4 " * 30, "LOUD WORDS ONLY " * 20, "w" * 100_000, *sentences(3, 20, words=90)]


def test_ledger_equals_brute_force(spark):
    docs = documents(spark, QUALITY_TEXTS).repartition(3)
    rows = {r.id: r.asDict() for r in quality.ledger(docs).collect()}
    assert len(rows) == len(QUALITY_TEXTS)
    for i, t in enumerate(QUALITY_TEXTS):
        m = brute_measures(t)
        assert {k: rows[i][k] for k in m} == m, t
        bits = sum(1 << n for n, r in enumerate(quality.RULES) if spark_free_eval(r.fails, m))
        assert rows[i]["failed"] == bits


def spark_free_eval(sql, m):
    return eval(sql, {}, m)          # the rules are plain comparisons


def test_policies_and_ablations(spark):
    led = quality.ledger(documents(spark, QUALITY_TEXTS)).cache()
    bits = [r.failed for r in led.collect()]
    soft = quality.Policy("soft", ("few_words",), ("symbols", "capitals", "repeated_windows"), allowed=1)
    for policy in (*quality.POLICIES.values(), soft):
        def keeps(b):
            return not b & quality.mask(policy.veto) and bin(b & quality.mask(policy.counted)).count("1") <= policy.allowed
        assert led.where(quality.passes(policy)).count() == sum(map(keeps, bits))
        table = {r.rule: r for r in quality.ablations(led, policy).collect()}
        for n, rule in enumerate(quality.RULES):
            without = sum(keeps(b & ~(1 << n)) for b in bits)
            assert tuple(table[rule.name])[1:] == (sum(b >> n & 1 for b in bits), sum(map(keeps, bits)), without,
                                                   without - sum(map(keeps, bits)))
    assert sum(r.n for r in quality.patterns(led, ["n_words"]).collect()) == len(bits)
    with pytest.raises(ValueError, match="unknown rules"):
        quality.mask(["no_such_rule"])


def test_ledger_of_nothing(spark):
    led = quality.ledger(documents(spark, []))
    assert led.count() == 0
    assert {tuple(r)[1:] for r in quality.ablations(led, "strict").collect()} == {(0, 0, 0, 0)}
