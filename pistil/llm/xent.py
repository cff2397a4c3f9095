"""Cross-entropy difference scores from two matched bigram models.

The target model is learned from the documents labelled good, the background model from all
documents, both with the same vocabulary, order and smoothing. The vocabulary is every word of
the corpus and every bigram is counted as itself, so the models grow with the input; ``CLASSES`` is
the number of unseen words for which the smoothing keeps room.

Both models interpolate: P(w|v) = (c(v,w) + MU * P(w)) / (c(v) + MU) with
P(w) = (c(w) + 1/2) / (N + V/2). A document's score is its mean loss in bits per token under the target
model minus that under the background model: the lower, the more it is like the target.

The rows are stored once as segments of bounded size. A segment sends each of its distinct words, words
in front and bigrams once, with both counts, to the bucket of its hash; buckets add up and write
each segment the sums of its own keys, in the order in which they came. The size of the vocabulary and the
numbers of tokens are one small aggregate over the buckets. A word or context that is in
every row is thus one entry a segment, and no model is ever in one place. 63-bit hashes name words
and bigrams; a collision would add up two of them.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.

Defined results: a null text or one without words has 0 tokens and null losses and score; repeated
rows give a row each; labels that repeat or are null count once or not at all, and a good label
without a document adds nothing; without any good document the target model is uniform.
Other columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, lean, scratch_path, ship_package, table, text_column, write_bytes, written
from .words import U64, WORD_BYTES, mix, pieces, split_words

CLASSES = 512
MU = 64.0
SEGMENT_BYTES = 12 << 20         # text of a segment
START = U64(0x5851F42D4C957F2D)  # stands in front of a row's first word
FRONT = U64(0x14057B7EF767814F)
IS_WORD = U64(1)                 # lowest bit of a key: set for words only


def planes(x: np.ndarray, kind: str) -> bytes:
    """Values byte by byte, first all lowest bytes, and so on, compressed: what Spark sorts and sends is a third."""
    x = x.astype(kind)
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def write_segments(docs: DataFrame, path: str, segment_bytes: int) -> DataFrame:
    """Store ``id, text`` in files of about ``segment_bytes`` of text; ``segment, at, id`` of every row."""
    kind = dict(docs.dtypes)["id"]

    def store(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        segment = uuid.uuid4().int >> 65
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for b in rows:
                out.write_batch(b)
        write_bytes(f"{path}/{segment}", sink.getvalue())
        at = 0
        for b in rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b), segment)), pa.array(np.arange(at, at + len(b), dtype=np.int32)), b.column(0)],
                ["segment", "at", "id"])
            at += len(b)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            b = pa.RecordBatch.from_arrays([b.column(0), text_column(b, "text")], ["id", "text"])
            for lo, buf, off in pieces(b.column(1), segment_bytes):
                more = len(buf) + 64 * (len(off) - 1)
                if rows and size + more > segment_bytes:
                    yield from store(rows)
                    rows, size = [], 0
                rows.append(b.slice(lo, len(off) - 1))
                size += more
        yield from store(rows)

    return written(docs.mapInArrow(lean(cut), f"segment long, at int, id {kind}"), "xent_rows")


@dataclass
class Segment:
    """A stored segment and its keys: words, words in front (the last: a row's start), bigrams."""
    ids: pa.ChunkedArray
    tokens: np.ndarray       # of each row
    words: int               # distinct words
    word: np.ndarray         # number of each token's word
    front: np.ndarray        # and of the word in front of it
    pair: np.ndarray         # number of its bigram
    first: np.ndarray        # a token of each bigram
    keys: np.ndarray

    def counts(self, tokens: np.ndarray | slice) -> np.ndarray:
        """Count of each key over some of the tokens."""
        return np.concatenate([np.bincount(x[tokens], minlength=n) for x, n in
                               ((self.word, self.words), (self.front, self.words + 1), (self.pair, len(self.first)))])


def read_segment(path: str) -> Segment:
    fs, p = file_system(path)
    with fs.open_input_file(p) as f:
        t = pa.ipc.open_stream(f.read_buffer()).read_all()
    tokens, h = zip(*((np.diff(w.first), w.hash) for b in t.to_batches() for w in split_words(text_column(b, "text"), WORD_BYTES)))
    ids, tokens, h = t.column("id"), np.concatenate(tokens), np.concatenate(h)
    del t
    own, word = np.unique(h, return_inverse=True)
    word = word.astype(np.int32)
    front = np.empty_like(word)
    front[1:] = word[:-1]
    front[(np.cumsum(tokens) - tokens)[tokens > 0]] = len(own)
    before = mix(np.append(own, START) ^ FRONT)
    h += before[front]
    pairs, first, pair = np.unique(mix(h), return_index=True, return_inverse=True)
    keys = np.concatenate([own | IS_WORD, before & ~IS_WORD, pairs & ~IS_WORD])
    return Segment(ids, tokens, len(own), word, front, pair.astype(np.int32), first.astype(np.int32), keys)


def losses(s: Segment, counts: np.ndarray, total: int, size: int, mu: float = MU) -> np.ndarray:
    """Bits of each bigram of ``s`` under the interpolated model of ``counts`` (by key), ``total`` tokens
    and a vocabulary of ``size``."""
    one, front, pair = np.split(counts.astype(np.float64), [s.words, 2 * s.words + 1])
    base = (one + 0.5) / (total + 0.5 * size)
    return -np.log2((pair + mu * base[s.word[s.first]]) / (front[s.front[s.first]] + mu))


def score_documents(docs: DataFrame, good_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    classes: int = CLASSES, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``id, n_tokens, target_loss, background_loss, score`` of every row of ``docs``; the target model
    learns from the rows whose id is in ``good_ids`` (one column)."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = dict(docs.dtypes)[id_col]
    path = scratch_path(spark, "xent")
    rows = write_segments(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")),
                          path, segment_bytes)
    segments = max(1, rows.select("segment").distinct().count())
    buckets = max(8, segments)                   # about as many keys as a segment's
    # the labels have no size bound: never broadcast, so the plan is the same at every size
    good = good_ids.toDF("id").where("id is not null").distinct().withColumn("good", F.lit(True)).hint("merge")
    marked = rows.join(good, "id", "left").select("segment", F.when(F.col("good"), F.col("at")).alias("at"))

    def count(t: pa.Table) -> pa.Table:
        segment = t.column("segment")[0].as_py()
        s = read_segment(f"{path}/{segment}")
        chosen = np.zeros(len(s.tokens), dtype=bool)
        chosen[t.column("at").drop_null().to_numpy()] = True
        order = np.argsort(s.keys, kind="stable")
        cut = np.searchsorted((s.keys[order] >> U64(40)) * U64(buckets) >> U64(24), np.arange(buckets + 1, dtype=U64))
        full = np.flatnonzero(np.diff(cut))
        columns = ((s.keys[order], "<u8"), (s.counts(slice(None))[order], "<u4"),
                   (s.counts(np.repeat(chosen, s.tokens))[order], "<u4"))
        return pa.table([pa.array(np.full(len(full), segment)), pa.array(full.astype(np.int32)),
                         *(pa.array([planes(x[cut[j]:cut[j + 1]], k) for j in full.tolist()], pa.binary()) for x, k in columns)],
                        names=["segment", "bucket", "keys", "background", "target"])

    def add(t: pa.Table) -> pa.Table:
        parts = [unplanes(k, "<u8") for k in t.column("keys").to_pylist()]
        cut = np.cumsum([0, *map(len, parts)])
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        is_word = (keys & IS_WORD) == IS_WORD
        once = np.zeros(len(parts), dtype=bool)       # the bucket's own totals stand in one of its rows
        once[0] = True
        columns, totals = [], [np.where(once, is_word.sum(), 0)]
        for name in ("background", "target"):
            n = np.concatenate([unplanes(x, "<u4") for x in t.column(name).to_pylist()])
            n = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
            totals.append(np.where(once, n[is_word].sum(), 0))
            columns.append(pa.array([planes(n[at[a:b]], "<i8") for a, b in zip(cut, cut[1:])], pa.binary()))
        return pa.table([t.column("segment"), t.column("bucket"), *columns, *map(pa.array, totals)],
                        names=["segment", "bucket", "background", "target", "words", "n_background", "n_target"])

    def score(t: pa.Table) -> pa.Table:
        t = t.sort_by("bucket")
        s = read_segment(f"{path}/{t.column('segment')[0].as_py()}")
        order = np.argsort(s.keys, kind="stable")
        size = total["words"] + classes
        row = np.repeat(np.arange(len(s.tokens)), s.tokens)
        out = []
        for name in ("target", "background"):
            n = np.empty(len(order), dtype=np.int64)
            n[order] = np.concatenate([unplanes(x, "<i8") for x in t.column(name).to_pylist()])
            bits = losses(s, n, total[f"n_{name}"], size)
            out.append(np.bincount(row, weights=bits[s.pair], minlength=len(s.tokens)) / np.maximum(s.tokens, 1))
        none = s.tokens == 0
        return pa.table([s.ids, pa.array(s.tokens), *(pa.array(x, mask=none) for x in (*out, out[0] - out[1]))],
                        names=["id", "n_tokens", "target_loss", "background_loss", "score"])

    # explicit numbers of partitions: the work of a segment is not seen in the bytes shuffled to it
    sums = written(marked.repartition(segments, "segment").groupBy("segment")
                         .applyInArrow(lean(count), "segment long, bucket int, keys binary, background binary, target binary")
                         .repartition(buckets, "bucket").groupBy("bucket")
                         .applyInArrow(lean(add), "segment long, bucket int, background binary, target binary, words long, "
                                            "n_background long, n_target long"), "xent_sums")
    totals = ("words", "n_background", "n_target")
    total = {k: v or 0 for k, v in sums.agg(*(F.sum(c).alias(c) for c in totals)).first().asDict().items()}
    return (sums.drop(*totals).repartition(segments, "segment").groupBy("segment")
                .applyInArrow(lean(score), f"id {kind}, n_tokens long, target_loss double, background_loss double, score double"))


def op10_xent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of all ``documents``; target: those with a label of quality 1."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score_documents(table(spark, sf_dir, "documents"), good).withColumnRenamed("id", "doc_id")
