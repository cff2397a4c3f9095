"""Small document tables and brute-force twins for the operator tests."""

import random
import re

LOWER = {i: i + 32 for i in range(65, 91)}
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row long, id long, key long, node long, segment long, shard int, bucket int, score double, kept string, "
            "digest string, n_bytes long, lang_pred string, component_id long, size int, tie long")


def documents(spark, texts, ids=None, clashing=True):
    """A ``documents`` table, with further columns that are named like internal ones."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"src{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(zip(ids, texts))]
    if not clashing:
        return spark.createDataFrame(rows, DOC_SCHEMA)
    extra = (7, 7, 7, 7, 7, 7, 7, 0.5, "x", "x", 7, "x", 7, 7, 7)
    return spark.createDataFrame([r + extra for r in rows], f"{DOC_SCHEMA}, {CLASHING}")


def sentences(seed, n, words=60, vocabulary=400):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(words // 2, words))) for _ in range(n)]


def near_copy(text, seed, every=40):
    w = text.split()
    rng = random.Random(seed)
    for i in range(rng.randrange(every), len(w), every):
        w[i] = w[i] + "x"
    return " ".join(w)


ODD_TEXTS = [None, "", " ", "a", "one two", "É", "123 456", "\n\n\t", "Ünï cödé tëxt with ß and ñ", "x" * 5000,
             "ab " * 4000, "ab " * 4000, "tie tie tie tie tie tie tie", "same words here", "same words here"]


def words_of(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def components(nodes, links):
    low = {x: x for x in nodes}

    def top(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        low[b] = a
    return {x: top(x) for x in nodes}
