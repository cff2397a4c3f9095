"""Benchmark decontamination with a positional inverted index.

The training documents are split into segments of whole documents (about 2 MB of text; a longer
document is a segment of its own). A segment stores its sorted term hashes and, for every term,
the sorted positions of all its tokens. Segments are rows of a written table, so the index is
built by one pass without a shuffle and any later set of test items can be matched against it.

Matching a segment starts from each test window's rarest term there (the shortest posting
list), shifts its positions by the term's offset in the window and intersects them with the
shifted lists of the other terms, next rarest first. All windows of a round are intersected
together. Test windows are read by the tasks in rounds of bounded size, so their number may
grow too.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased, compared by 64-bit
hashes. A window is ``size`` consecutive words of an item; an item of fewer words, but not none,
is one window.

Defined results: null or empty texts have no words; a document is judged row by row, so repeated
rows or ids give a row each and null ids are kept; items without words make no window, items
that repeat count once per item id (compared as text; null ids are left out); an empty
benchmark hits nothing; empty documents give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, free_name, lean, scratch_path, ship_package, table, text_column, written
from .words import WORD_BYTES, split_words

WINDOW = 10
SEGMENT_BYTES = 2 << 20
ROUND_WINDOWS = 100_000
U64 = np.uint64


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Segments: ``ids`` and word offsets ``first`` of their documents, sorted ``terms`` (uint64),
    ``ends`` of their lists (uint32) and ``places`` (uint32), all as little-endian bytes.

    A place is the word's number in the segment plus the number of documents before it, so
    consecutive places never span two documents.
    """
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in split_words(text_column(b, "text"), WORD_BYTES, segment_bytes):
                order = np.argsort(w.hash, kind="stable")
                sorted_hash = w.hash[order]
                new = np.flatnonzero(np.concatenate([[True], sorted_hash[1:] != sorted_hash[:-1]])[:len(order)])
                place = (np.arange(len(order)) + w.row)[order].astype("<u4")
                ends = np.append(new[1:], len(order)).astype("<u4") if len(new) else new.astype("<u4")
                ids = b.column(0).slice(w.lo, w.rows)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, w.rows], pa.int32()), ids),
                    *(pa.array([x.tobytes()], pa.binary()) for x in
                      (w.first.astype("<u4"), sorted_hash[new].astype("<u8"), ends, place))],
                    ["ids", "first", "terms", "ends", "places"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        lean(run), f"ids array<{kind}>, first binary, terms binary, ends binary, places binary")


def write_index(index: DataFrame, path: str) -> DataFrame:
    """Store segments in small row groups (a reader holds one group at a time)."""
    (index.write.option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 1)
          .option("compression", "zstd").parquet(path))
    return index.sparkSession.read.schema(index.schema).parquet(path)


def write_windows(items: DataFrame, path: str, id_col: str = "item_id", text_col: str = "text",
                  size: int = WINDOW, round_windows: int = ROUND_WINDOWS) -> int:
    """Store the items' windows (``item``, ``words``) under ``path/round=k``; returns the rounds."""
    ship_package(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0).to_pylist()
            for w in split_words(text_column(b, "text"), WORD_BYTES):
                item, words = [], []
                for i in range(w.rows):
                    h = w.hash[w.first[i]:w.first[i + 1]].astype("<u8")
                    for s in range(max(1, len(h) - size + 1) if len(h) else 0):
                        item.append(names[w.lo + i])
                        words.append(h[s:s + size].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(words, pa.binary())],
                                                 ["item", "words"])

    rows = written(items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
                        .where("item is not null")
                        .mapInArrow(lean(run), "item string, words binary").distinct(), "windows")
    rounds = max(1, -(-rows.count() // round_windows))
    (rows.withColumn("round", F.pmod(F.xxhash64("item", "words"), F.lit(rounds)).cast("int"))
         .repartition(rounds, "round").write.partitionBy("round").parquet(path))
    return rounds


class Windows:
    """One round of test windows as arrays."""

    def __init__(self, path: str, number: int):
        fs, base = file_system(f"{path}/round={number}")
        names, words = [], []
        if fs.get_file_info(base).type.name == "Directory":
            t = pads.dataset(base, filesystem=fs, format="parquet").to_table(columns=["item", "words"])
            names, words = t.column("item").to_pylist(), t.column("words").to_pylist()
        self.items = sorted(set(names))
        at = {x: i for i, x in enumerate(self.items)}
        self.item = np.array([at[x] for x in names], dtype=np.int64)
        self.size = np.array([len(x) // 8 for x in words], dtype=np.int64)
        self.terms = np.unique(np.frombuffer(b"".join(words), dtype="<u8")) if words else np.zeros(0, "<u8")
        self.term = np.full((len(words), int(self.size.max(initial=1))), -1, dtype=np.int64)
        for i, x in enumerate(words):
            self.term[i, :len(x) // 8] = np.searchsorted(self.terms, np.frombuffer(x, dtype="<u8"))


class Segment:
    """The lists of one segment for the terms of a round, ordered by (term, place)."""

    def __init__(self, windows: Windows, terms: np.ndarray, ends: np.ndarray, places: np.ndarray):
        at = np.searchsorted(terms, windows.terms)
        at = np.minimum(at, max(len(terms) - 1, 0))
        here = terms[at] == windows.terms if len(terms) else np.zeros(len(windows.terms), dtype=bool)
        begin = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(1, np.int64)
        self.count = np.where(here, (ends.astype(np.int64)[at] - begin[at]) if len(ends) else 0, 0)
        self.end = np.cumsum(self.count)
        self.begin = self.end - self.count
        take = np.repeat(begin[at] - self.begin, self.count) + np.arange(int(self.count.sum()))
        self.place = places[take].astype(np.int64)
        self.key = (np.repeat(np.arange(len(at)), self.count) << 32) + self.place   # ascending

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = (term << 32) + place
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return (self.key[at] == key) & (place >= 0)


def _lists(seg: Segment, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner (index into ``term``) and place of every posting of the given terms."""
    n = seg.count[term]
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(term)), n)
    return owner, seg.place[seg.begin[term][owner] + np.arange(len(owner)) - first[owner]]


def phrase_matches(w: Windows, seg: Segment) -> tuple[np.ndarray, np.ndarray]:
    """``(window, first place)`` of every occurrence of a window as a phrase."""
    used = w.term >= 0
    count = np.where(used, seg.count[w.term] if len(seg.count) else 0, np.iinfo(np.int64).max)
    live = np.flatnonzero((count > 0).all(1)) if len(w.term) else np.zeros(0, np.int64)
    if not len(live):
        return live, live
    order = np.argsort(count[live], axis=1, kind="stable")          # rarest term first
    owner, place = _lists(seg, w.term[live, order[:, 0]])
    start = place - order[owner, 0]
    for j in range(1, w.term.shape[1]):
        offset = order[owner, j]
        term = w.term[live[owner], offset]
        ok = (term < 0) | seg.has(np.maximum(term, 0), start + offset)
        owner, start = owner[ok], start[ok]
    return live[owner], start


def proximity_matches(w: Windows, seg: Segment, doc_place: np.ndarray, slop: int) -> Iterator[tuple[int, int, int]]:
    """``(window, first place, last place)`` of the shortest stretches, inside one document, of at
    most the window's length plus ``slop`` places that hold all its terms in any order."""
    for k in range(len(w.term)):
        terms = np.unique(w.term[k, :w.size[k]])
        if not len(terms) or (seg.count[terms] == 0).any():
            continue
        reach = int(w.size[k]) + slop
        rare = terms[np.argmin(seg.count[terms])]
        anchor = seg.place[seg.begin[rare]:seg.end[rare]]
        near = []
        for t in terms.tolist():
            p = seg.place[seg.begin[t]:seg.end[t]]
            at = np.searchsorted(anchor, p)
            gap = np.minimum(np.abs(p - anchor[np.minimum(at, len(anchor) - 1)]),
                             np.abs(p - anchor[np.maximum(at - 1, 0)]))
            near += [(int(x), t) for x in p[gap < reach]]
        near.sort()
        last: dict[int, int] = {}
        for place, t in near:
            last[t] = place
            if len(last) == len(terms):
                low = min(last.values())
                same = np.searchsorted(doc_place, low, "right") == np.searchsorted(doc_place, place, "right")
                if place - low < reach and same:
                    yield k, low, place
                    del last[next(x for x in last if last[x] == low)]


def match_documents(index: DataFrame, windows_path: str, rounds: int, id_name: str = "doc_id",
                    slop: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted ids of the items met) of every document.

    A word is hit when it lies in an occurrence of a window; with ``slop`` in a stretch that
    ``proximity_matches`` finds.
    """
    kind = dict(index.dtypes)["ids"][6:-1]
    loaded: list = [None, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                ids = b.column(0)[i].values
                first, terms, ends, places = (np.frombuffer(b.column(c)[i].as_buffer(), dtype=t)
                                              for c, t in ((1, "<u4"), (2, "<u8"), (3, "<u4"), (4, "<u4")))
                n = len(first) - 1
                first = first.astype(np.int64)
                doc_place = first[:-1] + np.arange(n)
                total = int(first[-1]) + n
                cover = np.zeros(total + 1, dtype=np.int64)
                met: list[set] = [set() for _ in range(n)]
                for k in range(rounds):
                    if loaded[0] != k:
                        loaded[:] = [k, Windows(windows_path, k)]
                    w = loaded[1]
                    seg = Segment(w, terms, ends, places)
                    if slop is None:
                        win, start = phrase_matches(w, seg)
                        stop = start + w.size[win]
                    else:
                        found = list(proximity_matches(w, seg, doc_place, slop))
                        win, start, stop = (np.array(x, dtype=np.int64) for x in (zip(*found) if found else ([], [], [])))
                        stop = stop + 1
                    np.add.at(cover, start, 1)
                    np.add.at(cover, stop, -1)
                    doc = np.searchsorted(doc_place, start, side="right") - 1
                    for d, it in np.unique(np.stack([doc, w.item[win]], 1), axis=0).tolist() if len(win) else ():
                        met[d].add(w.items[it])
                inside = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
                hit = inside[doc_place + np.diff(first)] - inside[doc_place]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(first)), pa.array(hit),
                     pa.array([sorted(x) for x in met], pa.list_(pa.string()))],
                    [id_name, "n_words", "n_hit", "items"])

    return index.mapInArrow(lean(run), f"`{id_name}` {kind}, n_words long, n_hit long, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  size: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Build the index of ``docs`` and match the items of ``items`` (``item_id``, ``text``)."""
    spark = docs.sparkSession
    windows = scratch_path(spark, "test_windows")
    rounds = write_windows(items, windows, size=size)
    index = write_index(build_index(docs, id_col, text_col), scratch_path(spark, "postings"))
    return match_documents(index, windows, rounds, id_col, slop)


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of benchmark windows."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in which no benchmark window occurs.

    The verdict depends on the text alone, so it is joined back by the text's digest.
    """
    key = free_name(docs.columns, "digest")
    keyed = docs.withColumn(key, F.md5(F.encode("text", "UTF-8")))
    found = decontaminate(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    bad = written(found.where("n_hit > 0").select(key).distinct(), "contaminated")
    return keyed.join(bad, key, "left_anti").select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, list_slice(w, s, s + least(len(w), 10) - 1) AS words
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
spans AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k),
hits AS (
  SELECT doc_id, s, spans.k, item FROM spans JOIN win
  ON win.k = spans.k AND win.words = list_slice(w, s, s + spans.k - 1)),
words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
