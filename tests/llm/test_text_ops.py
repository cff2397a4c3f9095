"""N-gram join, repeated strings, decontamination, language ID and scores against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pistil.llm import decontam, langid, ngram_join, repeats, xent
from pistil.llm.components import components as spark_components

from .helpers import ODD_TEXTS, components, documents, near_copy, sentences, words_of

SPACE = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def corpus(seed=1):
    base = sentences(seed, 30, words=150)
    passage = " ".join(sentences(seed + 1, 3))
    texts = base + [near_copy(base[0], i) for i in range(12)] + [near_copy(base[1], i, 9) for i in range(8)]
    texts += [base[2]] * 6 + [f"{t} {passage}" for t in base[3:9]] + [base[4].upper(), base[4].replace(" ", "\t ")]
    return texts + ODD_TEXTS


# ------------------------------------------------------------------ n-gram join

def shingles(text, k=5):
    w = words_of(text, SPACE)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def joined(texts):
    sets = [shingles(t) for t in texts]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), r) for i, r in components(range(len(sets)), links).items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_equals_brute_force(spark, seed):
    texts = corpus(seed)
    random.Random(seed).shuffle(texts)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(documents(spark, texts)).collect()}
    assert got == joined(texts)


def test_ngram_join_cells_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 4)
    texts = corpus(3)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(documents(spark, texts)).collect()}
    assert got == joined(texts)


def test_ngram_join_split_lists(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LIST", 2)
    texts = corpus(4)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(documents(spark, texts)).collect()}
    assert got == joined(texts)


def test_ngram_join_repeated_and_missing_ids(spark):
    a, b = sentences(5, 2)
    rows = ngram_join.similar_components(documents(spark, [a, a, b, a, None], ids=[4, 4, None, 2, 9])).collect()
    got = Counter((r["id"], r["component_id"]) for r in rows)
    assert got == Counter([(4, 2), (4, 2), (None, None), (2, 2), (9, 9)])


def test_ngram_join_empty_table(spark):
    assert ngram_join.similar_components(documents(spark, [])).collect() == []


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    a, b, c = sentences(6, 3)
    docs = documents(spark, [a, near_copy(a, 1, 70), a, b, None, "", c, c], ids=[5, 3, 3, 1, None, 8, 6, 6])
    out = ngram_join.keep_first_of_group(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"] is None, r["doc_id"]) for r in out.collect()), key=str) == sorted(
        [(False, 3), (False, 1), (True, None), (False, 8), (False, 6)], key=str)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 200)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(links)
    nodes = {x for p in links for x in p}
    got = {r["node"]: r["root"] for r in spark_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == components(nodes, links)


# ------------------------------------------------------------------ repeated strings

def cut(texts, ids, size=50):
    rows = [((t or "").encode(), i) for t, i in zip(texts, ids)]
    first = {}
    for b, i in rows:
        key = math.inf if i is None else i
        for s in range(len(b) - size + 1):
            first[b[s:s + size]] = min(first.get(b[s:s + size], math.inf), key)
    out = []
    for b, i in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if first[b[s:s + size]] < (math.inf if i is None else i):
                gone[s:s + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def removed(spark, texts, ids, **how):
    rows = repeats.remove_repeats(documents(spark, texts, ids), **how).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", 4000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    texts = corpus(seed) + ["ab" * 300, "xx" + "ab" * 200 + "yy", "z" * 49, "z" * 49, "z" * 50, "é" * 60, "aé" * 40 + "é" * 60]
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    ids[3], ids[8], ids[20] = ids[2], None, None
    assert removed(spark, texts, ids) == cut(texts, ids)


def long_stretches(seed, pairs):
    """Pairs that share rows of a table, rulers and markup: one anchor recurs, stretches get long."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    out = []
    for i in range(pairs):
        kind = i % 4
        if kind == 0:
            cell = word(29)
            shared = "".join(f"{cell}{rng.randrange(10, 99)}" for _ in range(8))
        elif kind == 1:
            shared = "".join(f"{'-' * 24}{n:02d}" for n in range(rng.randrange(5, 15)))
        elif kind == 2:
            shared = "".join(f"<td class='c'>{rng.randrange(9)}</td>" for _ in range(12))
        else:
            shared = word(7) * rng.randrange(10, 40) + "\0" * rng.randrange(70)
        for _ in range(2):
            out.append(word(rng.randrange(30)) + shared[rng.randrange(30):len(shared) - rng.randrange(30)] + word(rng.randrange(30)))
    return out


def test_repeats_in_long_stretches(spark):
    texts = long_stretches(5, 120)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    assert removed(spark, texts, ids) == cut(texts, ids)


@pytest.mark.parametrize("step, chunk", [(7, 5), (1 << 20, 60), (1 << 20, 1 << 17)])
def test_bucket_answers_are_exact(step, chunk):
    """Any contents in one bucket under few keys, zero bytes and prefixes of each other included."""
    rng = random.Random(step + chunk)
    for _ in range(40):
        size = rng.choice([3, 5, 50])
        unit = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 9))) for _ in range(3)]
        contents = [(b"".join(rng.choice(unit) for _ in range(rng.randrange(60))) + b"a" * size)[:rng.randrange(size, 260)]
                    for _ in range(rng.randrange(1, 9))]
        key = np.array([len(c) % 2 for c in contents], dtype="<u4")
        low = np.array([rng.randrange(50) for _ in contents])
        where = {}
        for c, k, m in zip(contents, key.tolist(), low.tolist()):
            for i in range(len(c) - size + 1):
                where.setdefault(c[i:i + size], []).append((k, m))
        best, _ = repeats.bucket_answers(contents, key, low, size, step=step, chunk=chunk)
        for c, k, got in zip(contents, key.tolist(), best):
            for i, x in enumerate(got.tolist()):
                # equal strings have one anchor, so those of other keys may be met or not
                found = where[c[i:i + size]]
                assert min(m for _, m in found) <= x <= min(m for kk, m in found if kk == k)


def test_repeats_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).collect() == []


def test_common_prefix_intervals_and_maximal_repeats():
    text = b"#abcab" + b"%abcac" + b"$xabca"
    low = np.zeros(3, dtype=np.int64)
    contents = [b"#abcab", b"%abcac", b"$xabca"]
    best, found = repeats.bucket_answers(contents, low.astype("<u4"), np.array([5, 3, 9]), 3)
    got = {(s, tuple(sorted(o)), m) for s, o, m in found()}
    assert text and got == {(b"abca", ((0, 1), (1, 1), (2, 2)), 3)}
    assert [x.tolist() for x in best] == [[5, 3, 3, 5], [3, 3, 3, 3], [9, 9, 3, 3]]


def test_repeats_stage_columns_and_texts(spark):
    a, b = sentences(9, 2)
    docs = documents(spark, [a, f"{b} {a}", a, None, "", "short"], ids=[1, 2, 3, 4, None, 6])
    out = repeats.drop_repeats(spark, docs, "")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 4, None, 6} and got[1]["text"] == a and got[4]["text"] is None
    assert got[2]["text"] == b + " " and got[2]["n_chars"] == len(b) + 1 and got[2]["kept"] == "x"


# ------------------------------------------------------------------ decontamination

def hits(texts, items, size=10):
    wins = {}
    for item, t in items:
        w = words_of(t, WORD)
        for s in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + size]), set()).add(str(item))
    out = []
    for i, t in enumerate(texts):
        w = words_of(t, WORD)
        hit, met = set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in wins:
                    hit |= set(range(s, s + n))
                    met |= wins[k]
        out.append((i, len(w), len(hit), sorted(met)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, words long")


def test_decontamination_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SEGMENT_BYTES", 3000)
    base = sentences(11, 20, words=80)
    items = [(10, base[0]), (2, " ".join(base[1].split()[:4])), (3, base[2]), (3, base[2]), (5, ""), (6, None), (7, "ab ab ab"),
             (8, " ".join(["ab"] * 14)), (9, "same words")]
    texts = [f"{base[5]} {base[0].upper()}", base[0], base[1], base[6] + ". " + " ".join(base[2].split()[5:25]), base[7]]
    texts += ["Ab, ab! AB", " ".join(base[0].split()[:9])] + ODD_TEXTS
    found = decontam.decontaminate(documents(spark, texts), benchmark(spark, items)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found) == hits(texts, items)


def test_decontamination_in_several_rounds(spark, tmp_path):
    base = sentences(12, 12, words=80)
    items = [(i, t) for i, t in enumerate(base[:6])]
    texts = [f"{base[i]} {base[11 - i]}" for i in range(6)]
    rounds = decontam.write_windows(benchmark(spark, items), f"{tmp_path}/w", round_windows=20)
    assert rounds > 3
    index = decontam.write_index(decontam.build_index(documents(spark, texts)), f"{tmp_path}/i")
    found = decontam.match_documents(index, f"{tmp_path}/w", rounds).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found) == hits(texts, items)


def test_proximity_finds_scattered_words(spark):
    docs = documents(spark, ["aa x bb y cc z", "cc bb aa", "aa bb", "aa q q q q q q bb cc", None])
    found = decontam.decontaminate(docs, benchmark(spark, [(1, "aa bb cc")]), slop=2).collect()
    assert {r["doc_id"]: r["n_hit"] for r in found} == {0: 5, 1: 3, 2: 0, 3: 0, 4: 0}


def test_decontamination_of_nothing(spark):
    items = benchmark(spark, [(1, "aa bb")])
    assert decontam.decontaminate(documents(spark, []), items).collect() == []
    none = decontam.decontaminate(documents(spark, ["aa bb"]), benchmark(spark, [])).collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in none] == [(2, 0, [])]


# ------------------------------------------------------------------ language ID

LANGS = {"en": "the and ing that with was for this", "de": "der die und ein ich nicht auf ist", "fr": "le les une dans qui pour est avec"}
SCRIPTS = {"ru": "это не что как было для они все", "uk": "це не що як було для вони всі", "zh": "我们 可以 这个 没有 什么 时候 知道 现在",
           "ja": "これは それが ありません でした という ました", "el": "και στο από για δεν είναι που"}


def language_texts(seed, n, langs=LANGS):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(langs))
        out.append((i, " ".join(rng.choice(langs[lang].split()) for _ in range(rng.randint(5, 40))), lang))
    return out


def code_length_by_hand(texts, text):
    """PPM with the plain recursion over contexts of one language."""
    counts = Counter()
    pad = [32] * langid.DEPTH
    for t in texts:
        s = pad + list(t.encode().lower())
        for i in range(langid.DEPTH, len(s)):
            for d in range(langid.DEPTH + 1):
                counts[tuple(s[i - d:i]), s[i]] += 1
    total, kinds = Counter(), Counter()
    for (ctx, _), n in counts.items():
        total[ctx] += n
        kinds[ctx] += 1
    bits, s = 0.0, pad + list(text.encode().lower())
    for i in range(langid.DEPTH, len(s)):
        for d in range(langid.DEPTH, -1, -1):
            ctx = tuple(s[i - d:i])
            if (ctx, s[i]) in counts:
                bits -= math.log2(counts[ctx, s[i]] / (total[ctx] + kinds[ctx]))
                break
            if ctx in total:
                bits -= math.log2(kinds[ctx] / (total[ctx] + kinds[ctx]))
        else:
            bits += math.log2(langid.SYMBOLS)
    return bits


def test_ppm_code_lengths_equal_the_recursion(spark):
    rows = language_texts(1, 60)
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    held = {r[0] for r in spark.createDataFrame(rows, "doc_id long, text string, lang string")
            .where(langid.held_out("doc_id")).select("doc_id").collect()}
    for text in ("the thing über xyz", "qui est là", "0", "ÜBER The Привет 你好 \x00\x7f"):
        buf = np.frombuffer(text.encode(), dtype=np.uint8)
        got = langid.code_lengths(model, buf, np.array([0, len(buf)]))[0]
        want = [code_length_by_hand([t for i, t, k in rows if k == lang and i not in held], text) for lang in model.languages]
        assert got == pytest.approx(want, rel=1e-4)


def test_languages_of_held_out_rows(spark):
    docs = spark.createDataFrame(language_texts(2, 300), "doc_id long, text string, lang string")
    rows = langid.predict(docs, langid.train(docs)).where(langid.held_out("doc_id")).collect()
    assert len(rows) > 30 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_scripts_beside_a_large_latin_sample(spark):
    """Few documents of each script among very many Latin ones: every byte keeps its own statistics."""
    rows = language_texts(4, 600) + [(1000 + i, t, k) for i, t, k in language_texts(5, 150, SCRIPTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.train(docs)).where(langid.held_out("doc_id")).where("doc_id >= 1000").collect()
    assert len(got) > 20 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.95


def test_code_tables():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 32, 5000).astype(np.uint32))
    slots = langid.Slots(keys)
    other = rng.integers(0, 1 << 32, 20_000).astype(np.uint32)
    assert (slots.of(keys) == np.arange(1, len(keys) + 1)).all()
    assert ((slots.of(other) > 0) == np.isin(other, keys)).all()
    assert langid.Slots(keys[:0]).of(other).sum() == 0


def test_stage_drops_what_no_language_codes(spark):
    rng = random.Random(7)
    alien = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300))
    rows = language_texts(6, 90) + [(200, alien, None), (201, alien[:20], None), (202, "12 34", None), (203, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in langid.keep_identified(spark, docs, "").collect()} == {*range(90), 201}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in langid.keep_identified(spark, unlabelled, "").collect()} == {*range(90), 200, 201}


def test_texts_without_letters(spark):
    train = spark.createDataFrame(language_texts(3, 60) + [(None, "xx", "zz"), (1, None, "en"), (2, "the", None)],
                                  "doc_id long, text string, lang string")
    docs = documents(spark, ODD_TEXTS)
    rows = langid.predict(docs, langid.train(train)).collect()
    assert len(rows) == len(ODD_TEXTS) and rows[0].__fields__.count("score") == 1
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (r["score"] == 0.0) == (not letters)
    stage = langid.keep_identified(spark, docs, "")
    assert stage.columns == docs.columns
    assert {r["lang_pred"] for r in stage.collect()} == {"x"}


def test_language_id_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in langid.predict(docs, langid.train(docs)).collect()] == [("und", 0.0)]
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).collect() == []


# ------------------------------------------------------------------ scores

def scores_by_hand(texts, good, classes, mu):
    docs = [words_of(t, WORD) for t in texts]
    size = len({w for d in docs for w in d}) + classes

    def model(rows):
        pair, front, one = Counter(), Counter(), Counter()
        for d in rows:
            for a, b in zip(["^", *d], d):
                pair[a, b] += 1
                front[a] += 1
                one[b] += 1
        n = sum(one.values())
        return lambda a, b: -math.log2((pair[a, b] + mu * (one[b] + .5) / (n + .5 * size)) / (front[a] + mu))

    t, g = model([docs[i] for i in good]), model(docs)
    return [[sum(m(a, b) for a, b in zip(["^", *d], d)) / len(d) if d else None for m in (t, g)] for d in docs]


def test_scores_equal_a_dictionary_model(spark):
    texts = sentences(21, 25, words=40, vocabulary=60) + [None, "", "!!"]
    good = [0, 3, 4, 4, 9, None, 999]
    rows = xent.score_documents(documents(spark, texts), spark.createDataFrame([(g,) for g in good], "doc_id long")).collect()
    want = scores_by_hand(texts, [0, 3, 4, 9], xent.CLASSES, xent.MU)
    assert len(rows) == len(texts)
    for r in rows:
        t, g = want[r["id"]]
        if t is None:
            assert (r["n_tokens"], r["target_loss"], r["score"]) == (0, None, None)
        else:
            assert (r["target_loss"], r["background_loss"], r["score"]) == pytest.approx((t, g, t - g), abs=1e-4)


def test_scores_count_every_word_of_a_large_vocabulary(spark):
    texts = sentences(24, 300, words=60, vocabulary=6000)
    good = list(range(0, 300, 3))
    rows = xent.score_documents(documents(spark, texts), spark.createDataFrame([(g,) for g in good], "doc_id long"),
                                segment_bytes=4000).collect()
    want = scores_by_hand(texts, good, xent.CLASSES, xent.MU)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(want[r["id"]], abs=1e-9)


def test_scores_without_rows_or_targets(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert xent.score_documents(documents(spark, []), none).collect() == []
    rows = xent.score_documents(documents(spark, ["a b c", "a b"]), none).collect()
    assert all(r["target_loss"] > r["background_loss"] for r in rows)


def test_scores_rank_target_like_texts_first(spark):
    a, b = sentences(22, 60, words=60, vocabulary=80), sentences(23, 60, words=60, vocabulary=80)
    rows = xent.score_documents(documents(spark, a + b), spark.createDataFrame([(i,) for i in range(40)], "doc_id long")).collect()
    by = {r["id"]: r["score"] for r in rows}
    assert max(by[i] for i in range(40, 60)) < min(by[i] for i in range(60, 120))
