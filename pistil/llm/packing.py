"""Sequence packing along a space-filling curve.

Each document is tokenized, its hashed token vector is projected to a few dimensions by a
fixed random matrix, and the position along the Hilbert curve through that space is its sort
key. Documents are range-sorted by the key (ties, such as copies, by a hash of the id, so a
large group of copies spreads over many ranges) and laid end to end: neighbours on the curve
share sequences. A stream is cut every ``seq_len`` ids; what is left at the end of a range is
cut into powers of two, so no sequence needs padding.

Defined results: a null or empty text is the end id alone; rows that repeat an id are packed
once per row; a text of any length is one stream of ids, cut freely; null ids sort first and
are kept; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_array, lean, ship_package, table, written

SEQ_LEN = 1024
END_ID = 0
DIMS, BITS = 4, 15
BUCKETS = 256
# Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_BLANKS = re.compile(r"\s{50000}")      # the faster library's split pattern recurses over blanks
_loaded: dict[str, "Encoder"] = {}


def _byte_ranks(spec: str) -> dict[bytes, int] | None:
    """Byte-level BPE ranks of a tokenizer file, or None for other kinds.

    Only where merges are learned in id order, byte pairs are split by the usual pattern and
    nothing is normalised: there the same merges can be run by a faster library.
    """
    t = json.loads(spec)
    model, pre = t["model"], t.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or t.get("normalizer") or model.get("dropout")):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]       # bytes shown as themselves
    to_byte = {chr(c): c for c in shown}
    to_byte |= {chr(256 + i): c for i, c in enumerate(sorted(set(range(256)) - set(shown)))}
    special = {a["content"] for a in t.get("added_tokens", [])}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"].get(x + y, -1) for x, y in pairs]
    if any(i >= j for i, j in zip(ids, ids[1:])) or (ids and ids[0] < 256):
        return None
    return {bytes(to_byte[c] for c in w): i for w, i in model["vocab"].items() if w not in special}


class Encoder:
    """Ids of texts. Where the vocabulary allows it (see ``_byte_ranks``) the merges run in a
    faster library with the same ids; texts that spell a special token or hold a very long run of
    blanks, and all texts under other kinds of tokenizer, go through the tokenizer itself."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [a["content"] for a in json.loads(spec).get("added_tokens", [])]
        self.fast = None
        if ranks := _byte_ranks(spec):
            import tiktoken
            self.fast = tiktoken.Encoding("fast", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str], end_id: int = END_ID) -> list[bytes]:
        """Ids of each text with ``end_id`` behind, as little-endian bytes of ``dtype``."""
        kind, out, whole = self.dtype.char, [], []
        for i, t in enumerate(texts):
            if self.fast is None or any(x in t for x in self.special) or (len(t) >= 50_000 and _LONG_BLANKS.search(t)):
                whole.append(i)
                out.append(b"")
            else:
                ids = self.fast.encode_ordinary(t)
                ids.append(end_id)
                out.append(array(kind, ids).tobytes())
        if whole:
            got = self.tok.encode_batch([texts[i] for i in whole], add_special_tokens=False)
            for i, e in zip(whole, got):
                out[i] = array(kind, [*e.ids, end_id]).tobytes()
        return out


def hilbert_key(coords: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of integer points (rows of ``coords``, ``bits`` a dimension).

    Top bit first, each level undoes the rotation and reflection of the cells above it; the
    Gray-decoded bits of all dimensions are then interleaved.
    """
    x = [coords[:, j].astype(np.int64) for j in range(coords.shape[1])]
    d = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for j in range(d):
            on = (x[j] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[j]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if j:
                x[j] = x[j] ^ swap
    for j in range(1, d):
        x[j] = x[j] ^ x[j - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> b) & 1 == 1, flip ^ ((1 << b) - 1), flip)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for j in range(d):
            key = (key << 1) | (((x[j] ^ flip) >> b) & 1)
    return key


def project(ids: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Hilbert key of each row's hashed, damped and normalised token vector."""
    h = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
    slot = (h >> np.uint32(24)).astype(np.int64) % BUCKETS
    sign = 1.0 - 2.0 * ((h >> np.uint32(9)) & np.uint32(1))
    v = np.bincount(row * BUCKETS + slot, weights=sign, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    v = np.sign(v) * np.log1p(np.abs(v))
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    matrix = np.random.default_rng(20240101).standard_normal((BUCKETS, DIMS))
    p = v @ matrix                              # about normal, variance 1
    top = (1 << BITS) - 1
    return hilbert_key(np.clip((p + 4.0) / 8.0 * top, 0, top).astype(np.int64), BITS)


def tokenize(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str,
             end_id: int = END_ID, piece_chars: int = 1 << 20) -> DataFrame:
    """``doc_id, tie, key, n, width, ids``: ids as little-endian bytes, the curve position and
    a hash of the id that orders equal keys."""
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())   # one vocabulary file
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _loaded.get(spec.value)        # kept while the Python worker lives
        if enc is None:
            _loaded.clear()
            enc = _loaded[spec.value] = Encoder(spec.value)
        for b in batches:
            texts, lo = b.column(2).to_pylist(), 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= piece_chars):
                    size += len(texts[hi] or "")
                    hi += 1
                raw = enc.encode([t or "" for t in texts[lo:hi]], end_id)
                n = np.array([len(x) for x in raw], dtype=np.int64) // enc.dtype.itemsize
                ids = np.frombuffer(b"".join(raw), dtype=enc.dtype)
                key = project(ids, np.repeat(np.arange(hi - lo), n), hi - lo)
                off = np.zeros(len(n) + 1, dtype=np.int64)
                off[1:] = np.cumsum(n) * enc.dtype.itemsize
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(key),
                     pa.array(n), pa.array(np.full(hi - lo, enc.dtype.itemsize, dtype=np.int32)),
                     binary_array(ids.view(np.uint8), off).cast(pa.binary())],
                    ["doc_id", "tie", "key", "n", "width", "ids"])
                lo = hi

    return (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col)).alias("tie"),
                        F.col(text_col).cast("string").alias("text"))
                .mapInArrow(lean(run), f"doc_id {kind}, tie long, key long, n long, width int, ids binary"))


def _cut_points(total: int, seq_len: int, last: bool) -> np.ndarray:
    """Ends of the sequences of a stream of ``total`` ids (with ``last``, of all of it)."""
    full = np.arange(seq_len, total + 1, seq_len, dtype=np.int64)
    rest = total % seq_len
    if not last or not rest:
        return full
    ends, at = [], total - rest
    for bit in range(seq_len.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return np.concatenate([full, np.array(ends, dtype=np.int64)])


def pack(tokens: DataFrame, seq_len: int = SEQ_LEN, range_bytes: int = 32 << 20,
         with_ids: bool = True) -> DataFrame:
    """Pieces of ``tokenize`` rows (stored: the range sort reads them twice).

    One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    unless turned off, ``ids`` as little-endian unsigned 32-bit bytes.
    """
    if seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")
    ship_package(tokens.sparkSession)
    total = tokens.agg(F.sum(F.col("n") * F.col("width")).alias("b")).first()["b"] or 0
    ranges = max(1, -(-total // range_bytes))
    fields = [f for f in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    kind = dict(tokens.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_seq = TaskContext.get().partitionId() << 36
        held: list = []                          # pieces of the open sequence
        held_n, id_type = 0, None

        def cut(doc, first, size, ids, last):
            """Pieces of a stream: doc, first id number, document size per part, ids."""
            nonlocal next_seq
            lens = np.array([len(x) for x in ids], dtype=np.int64)
            part_end = np.cumsum(lens)
            stream = np.concatenate(ids).astype("<u4")
            ends = _cut_points(len(stream), seq_len, last)
            done = int(ends[-1]) if len(ends) else 0
            stop = np.union1d(part_end[part_end <= done], ends)
            begin = np.concatenate([[0], stop[:-1]]).astype(np.int64) if len(stop) else stop
            part = np.searchsorted(part_end, begin, side="right")
            part_begin = part_end - lens
            seq = np.searchsorted(ends, begin, side="right")
            seq_begin = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
            raw = stream.tobytes()
            crc = [zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(begin.tolist(), stop.tolist())]
            cols = [pa.array([doc[p] for p in part.tolist()], id_type),
                    pa.array(first[part] + begin - part_begin[part]), pa.array(stop - begin),
                    pa.array(crc, pa.int64()), pa.array(size[part]), pa.array(next_seq + seq),
                    pa.array(begin - seq_begin[seq])]
            if with_ids:
                cols.append(binary_array(stream.view(np.uint8)[:4 * done],
                                         4 * np.append(begin, done)).cast(pa.binary()))
            next_seq += len(ends)
            rest = []
            for i in range(len(ids)):
                if part_end[i] > done:
                    skip = max(0, done - int(part_begin[i]))
                    rest.append((doc[i], int(first[i]) + skip, int(size[i]), ids[i][skip:]))
            batch = (pa.RecordBatch.from_arrays(cols, ["doc_id", *fields, *["ids"] * with_ids])
                     if len(stop) else None)
            return batch, rest

        def pieces(more, last):
            parts = held + more
            return cut([p[0] for p in parts], np.array([p[1] for p in parts], dtype=np.int64),
                       np.array([p[2] for p in parts], dtype=np.int64), [p[3] for p in parts], last)

        for b in batches:
            id_type = b.schema.field(0).type
            docs, width, raw = b.column(0).to_pylist(), b.column(1), b.column(2)
            more, room = [], 0
            for i, doc in enumerate(docs):
                ids = np.frombuffer(raw[i].as_buffer(), dtype="<u2" if width[i].as_py() == 2 else "<u4")
                more.append((doc, 0, len(ids), ids))
                room += len(ids)
                if room >= 1 << 21 or i == len(docs) - 1:
                    out, held = pieces(more, False)
                    more, room = [], 0
                    if out is not None:
                        yield out
        if held:
            out, _ = pieces([], True)
            yield out

    schema = (f"doc_id {kind}, " + ", ".join(f"`{f}` long" for f in fields)
              + (", ids binary" if with_ids else ""))
    return (tokens.repartitionByRange(ranges, "key", "tie", "doc_id")
                  .sortWithinPartitions("key", "tie", "doc_id")
                  .select("doc_id", "width", "ids").mapInArrow(lean(run), schema))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", seq_len: int = SEQ_LEN, end_id: int = END_ID,
                   with_ids: bool = True) -> DataFrame:
    """Tokenize once (stored in the shared folder), then pack along the curve."""
    return pack(written(tokenize(docs, id_col, text_col, tokenizer_path, end_id), "tokens"),
                seq_len, with_ids=with_ids)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 ids; one row per piece."""
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False)


__all__ = ["Encoder", "hilbert_key", "op3_packing", "pack", "pack_documents",
           "tokenize"]


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: pieces with their ids."""
    return pack_documents(docs, default_tokenizer())
