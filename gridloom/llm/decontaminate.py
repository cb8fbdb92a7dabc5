"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed in segments of about a megabyte of text.  A segment is one row:
its documents, and for every term the sorted positions at which it stands.  A test
window is matched by taking the postings of its rarest term, shifting them by the
term's place in the window and intersecting them with the shifted postings of its
other terms, rarest first.  Segments are searched where they lie; the corpus text is
read once, when the index is built.  The same postings answer proximity: every term of a window
within some words of its rarest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import ranges, slices, word_hashes, words
from .scratch import cut

WINDOW = 13
#: An index that serves given tests only may leave out other terms if the tests have at most so many (their hashes go to every task).
VOCABULARY_ROWS = 2_000_000
#: Windows searched for at once; more are searched in blocks over the same index.
BLOCK_WINDOWS = 150_000
#: Keys of contaminated rows are broadcast up to this many.
BROADCAST_ROWS = 1_000_000
#: Bytes of text in one segment of the index.
_TEXT_BYTES = 1 << 20


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts, and the index of the first term of each text (n + 1 values)."""
    hashes, firsts, base = [], [np.zeros(1, np.int64)], 0
    for _, _, data, offsets in slices(texts):
        starts, ends, first = words(data, offsets, "alnum")
        hashes.append(word_hashes(data, starts, ends))
        firsts.append(first[1:] + base)
        base += len(starts)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def windows_of(tests: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows of the tests: item_id, terms array<bigint> (hashes); shorter items give one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, first = _terms(batch.column(1))
            sizes = np.diff(first)
            count = np.where(sizes == 0, 0, np.maximum(1, sizes - n + 1))
            length = np.repeat(np.minimum(sizes, n), count)
            start = ranges(first[:-1], count)
            flat = terms[ranges(start, length)].view(np.int64)
            offs = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
            item = pa.array(batch.column(0).to_numpy(zero_copy_only=False)).take(pa.array(np.repeat(np.arange(len(sizes)), count)))
            yield pa.RecordBatch.from_arrays([item.cast(pa.int64()), pa.ListArray.from_arrays(offs, pa.array(flat))], ["item_id", "terms"])

    rows = tests.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).where(F.col("item_id").isNotNull())
    return rows.mapInArrow(run, "item_id long, terms array<bigint>").distinct()


def build_index(docs: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """Write the index of ``docs`` (doc_id, text) and return it, one row per segment.

    Columns: seg long, a number of its own; doc_ids array<bigint>; prints array<bigint>, a hash of each text; doc_ends binary, int64 position behind each document
    (documents lie WINDOW apart, so no window spans two); n_words binary, int64; terms
    binary, uint64 ascending; term_ends binary, int64; postings binary, uint32 positions by
    term, each as difference to the one before.  ``vocabulary``: term hashes, ascending, to
    which the index is limited; None for all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = shared.value
        seg = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1), _TEXT_BYTES):
                starts, ends, first = words(data, offsets, "alnum")
                terms = word_hashes(data, starts, ends)
                sizes = np.diff(first)
                doc_ends = np.cumsum(sizes) + WINDOW * np.arange(len(sizes))
                place = ranges(doc_ends - sizes, sizes)
                if keep is not None:
                    if len(keep):
                        at = np.searchsorted(keep, terms)
                        at[at == len(keep)] = 0
                        known = keep[at] == terms
                    else:
                        known = np.zeros(len(terms), bool)
                    terms, place = terms[known], place[known]
                order = np.argsort(terms, kind="stable")
                terms, place = terms[order], place[order]
                own, begin = np.unique(terms, return_index=True)
                gaps = np.diff(place, prepend=0)
                gaps[begin] = place[begin]
                seg += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seg]), *(pa.array([batch.column(k)[a:b].to_pylist()], pa.list_(pa.int64())) for k in (0, 2)), pa.array([doc_ends.astype(np.int64).tobytes()]),
                     pa.array([sizes.astype(np.int64).tobytes()]), pa.array([own.tobytes()]),
                     pa.array([np.append(begin[1:], len(terms)).astype(np.int64).tobytes() if len(own) else b""]),
                     pa.array([gaps.astype(np.uint32).tobytes()])],
                    ["seg", "doc_ids", "prints", "doc_ends", "n_words", "terms", "term_ends", "postings"],
                )

    schema = "seg long, doc_ids array<bigint>, prints array<bigint>, doc_ends binary, n_words binary, terms binary, term_ends binary, postings binary"
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("print"))
    return cut(rows.mapInArrow(run, schema), "postings")


def posting_counts(index: DataFrame) -> DataFrame:
    """term bigint (hash), n long: postings in the whole corpus; no postings are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.diff(np.frombuffer(ends, np.int64), prepend=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, np.int64)), pa.array(n)], ["term", "n"])

    return index.select("terms", "term_ends").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Postings:
    """A segment's postings as sorted (term place, position) keys."""

    def __init__(self, terms: bytes, term_ends: bytes, postings: bytes):
        self.terms = np.frombuffer(terms, np.uint64)
        ends = np.frombuffer(term_ends, np.int64)
        self.begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        self.sizes = ends - self.begins
        run = np.cumsum(np.frombuffer(postings, np.uint32), dtype=np.int64)
        before = np.where(self.begins > 0, run[self.begins - 1], 0) if len(ends) else ends
        self.place = run - np.repeat(before, self.sizes)
        self.keys = np.repeat(np.arange(len(ends)) << 32, self.sizes) + self.place

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each term in this segment, -1 where it doesn't occur."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = (term << 32) + place
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (place >= 0) & (term >= 0)


class Phrases:
    """Windows with their terms in order of rarity."""

    def __init__(self, items: np.ndarray, terms: list[np.ndarray], counts: pd.Series):
        self.items, self.length = items, np.array([len(t) for t in terms], np.int64)
        flat = np.concatenate(terms) if len(terms) else np.zeros(0, np.int64)
        rarity = counts.reindex(flat).fillna(0).to_numpy()
        row = np.repeat(np.arange(len(terms)), self.length)
        offset = ranges(np.zeros(len(terms), np.int64), self.length)
        order = np.lexsort((offset, rarity, row))
        self.first = np.concatenate(([0], np.cumsum(self.length)))
        self.term, self.offset = flat[order].astype(np.int64).view(np.uint64), offset[order]

    def exact(self, p: Postings) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence in a segment."""
        local = p.find(self.term)
        complete = np.logical_and.reduceat(local >= 0, self.first[:-1]) if len(self.length) else np.zeros(0, bool)
        w = np.flatnonzero(complete)
        if not len(w):
            return w, w
        rarest = local[self.first[w]]
        n = p.sizes[rarest]
        start = p.place[ranges(p.begins[rarest], n)]
        w = np.repeat(w, n)
        start = start - self.offset[self.first[w]]
        for k in range(1, int(self.length.max())):
            if not len(w):
                break
            more = self.length[w] > k
            at = self.first[w] + np.where(more, k, 0)
            good = ~more | p.has(local[at], start + self.offset[at])
            w, start = w[good], start[good]
        return w, start

    def near(self, p: Postings, low: np.ndarray, ends: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its rarest term) where each of its terms stands within ``slop`` of that place in the same
        document; ``low`` and ``ends`` bound the documents of the segment."""
        local = p.find(self.term)
        complete = np.logical_and.reduceat(local >= 0, self.first[:-1]) if len(self.length) else np.zeros(0, bool)
        w = np.flatnonzero(complete)
        if not len(w):
            return w, w
        n = p.sizes[local[self.first[w]]]
        place = p.place[ranges(p.begins[local[self.first[w]]], n)]
        w = np.repeat(w, n)
        for k in range(1, int(self.length.max())):
            if not len(w):
                break
            doc = np.searchsorted(ends, place, "right")
            more = self.length[w] > k
            term = local[self.first[w] + np.where(more, k, 0)]
            at = np.searchsorted(p.keys, (term << 32) + np.maximum(low[doc], place - slop))
            found = p.keys[np.minimum(at, len(p.keys) - 1)]
            good = ~more | ((at < len(p.keys)) & (found <= (term << 32) + np.minimum(ends[doc] - 1, place + slop)))
            w, place = w[good], place[good]
        return w, place


def _phrases(windows: pd.DataFrame, counts: pd.Series) -> Phrases:
    return Phrases(windows["item_id"].to_numpy(np.int64), [np.asarray(t, np.int64) for t in windows["terms"]], counts)


def search(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Hits of one block of windows, one row per document of the index.

    seg long and ord int name the document's row; doc_id, print (hash of the text), n_words, hits
    array<struct<begin,end>> (word ranges, disjoint), items array<bigint>.
    """
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids, prints, doc_ends, n_words, terms, term_ends, postings = (batch.column(k)[row] for k in range(1, 8))
                ends, sizes = np.frombuffer(doc_ends.as_py(), np.int64), np.frombuffer(n_words.as_py(), np.int64)
                p = Postings(terms.as_py(), term_ends.as_py(), postings.as_py())
                w, start = f.exact(p)
                length = f.length[w]
                n = len(ends)
                cover = np.zeros(int(ends[-1]) + 2, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + length, -1)
                hit = np.cumsum(cover) > 0
                step = np.diff(hit.astype(np.int8), prepend=0)
                begin, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                doc = np.searchsorted(ends, begin, "right")
                low = (ends - sizes)[doc]
                hits = pa.ListArray.from_arrays(
                    np.searchsorted(doc, np.arange(n + 1)).astype(np.int32),
                    pa.StructArray.from_arrays([pa.array(begin - low), pa.array(stop - low)], ["begin", "end"]),
                )
                pair = np.unique(np.stack([np.searchsorted(ends, start, "right"), f.items[w]], 1), axis=0)
                items = pa.ListArray.from_arrays(np.searchsorted(pair[:, 0], np.arange(n + 1)).astype(np.int32), pa.array(pair[:, 1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(0)[row].as_py())), pa.array(np.arange(n, dtype=np.int32)), ids.values, prints.values, pa.array(sizes), hits, items],
                    ["seg", "ord", "doc_id", "print", "n_words", "hits", "items"],
                )

    return index.select("seg", "doc_ids", "prints", "doc_ends", "n_words", "terms", "term_ends", "postings").mapInArrow(
        run, "seg long, ord int, doc_id long, print long, n_words long, hits array<struct<begin:bigint,end:bigint>>, items array<bigint>"
    )


def _indexed(docs: DataFrame, tests: DataFrame, n: int, whole: bool) -> tuple[DataFrame, Iterator[Phrases]]:
    """The index of ``docs``, and the windows of ``tests`` in blocks with the rarity of their terms there."""
    windows = cut(windows_of(tests, n), "windows")
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    keep = None
    if not whole and vocabulary.limit(VOCABULARY_ROWS + 1).count() <= VOCABULARY_ROWS:
        keep = np.sort(vocabulary.toPandas()["term"].to_numpy(np.int64).view(np.uint64))
    index = build_index(docs, keep)
    counts = cut(posting_counts(index).join(vocabulary, "term", "left_semi"), "rarity")
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))

    def phrases() -> Iterator[Phrases]:
        for k in range(blocks):
            block = windows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == k) if blocks > 1 else windows
            own = counts.join(block.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi") if blocks > 1 else counts
            table = own.toPandas()
            yield _phrases(block.toPandas(), pd.Series(table["n"].to_numpy(np.int64), index=table["term"].to_numpy(np.int64)))

    return index, phrases()


def _found(docs: DataFrame, tests: DataFrame, n: int, whole: bool) -> DataFrame:
    """Exact hits: doc_id, print, n_words, hits, items for each row of ``docs``."""
    index, blocks = _indexed(docs, tests, n, whole)
    found = [search(index, phrases) for phrases in blocks]
    return found[0].drop("seg", "ord") if len(found) == 1 else _merged(found)


def decontaminate(docs: DataFrame, tests: DataFrame, n: int = WINDOW, whole: bool = True) -> DataFrame:
    """Match every window of ``tests`` (item_id, text) in ``docs`` (doc_id, text).

    One row per row of ``docs``: doc_id, n_words, hits array<struct<begin,end>> (disjoint
    word ranges), items array<bigint> (ascending).  With ``whole`` False the index takes in the terms of
    these tests only: the same rows from a smaller index.

    Null and empty texts have no words; a test without words or without item_id has no
    window.  Equal windows of several items count for each; repeated tests once.  Rows of
    ``docs`` that share a doc_id, null included, are each judged on their own text.
    """
    return _found(docs, tests, n, whole).drop("print")


def proximity_matches(docs: DataFrame, tests: DataFrame, slop: int, n: int = WINDOW, whole: bool = True) -> DataFrame:
    """Inexact matches: doc_id, item_id, place (word of the document), each once.

    At ``place`` stands the term of a window of the item that is rarest in ``docs`` (ties: the first in the window), and
    every other term of the window stands within ``slop`` words of it in the same document, in any order.
    Null and empty texts match nothing.  Rows that share a doc_id are each searched; equal places are told once.
    """
    index, blocks = _indexed(docs, tests, n, whole)

    def near(phrases: Phrases) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(phrases)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            f = shared.value
            for batch in batches:
                for row in range(batch.num_rows):
                    ids, doc_ends, n_words, *lists = (batch.column(k)[row] for k in range(6))
                    ends, sizes = np.frombuffer(doc_ends.as_py(), np.int64), np.frombuffer(n_words.as_py(), np.int64)
                    w, place = f.near(Postings(*(x.as_py() for x in lists)), ends - sizes, ends, slop)
                    doc = np.searchsorted(ends, place, "right")
                    yield pa.RecordBatch.from_arrays(
                        [ids.values.take(pa.array(doc)), pa.array(f.items[w]), pa.array(place - (ends - sizes)[doc])], ["doc_id", "item_id", "place"]
                    )

        return index.select("doc_ids", "doc_ends", "n_words", "terms", "term_ends", "postings").mapInArrow(run, "doc_id long, item_id long, place long")

    out = None
    for phrases in blocks:
        out = near(phrases) if out is None else out.unionByName(near(phrases))
    return out.distinct()


def _merged(found: list[DataFrame]) -> DataFrame:
    """Union the hits of several blocks, by document row; only rows that a block hits are brought together."""
    all_ = found[0].select("seg", "ord", "doc_id", "print", "n_words")
    rows = None
    for more in found:
        hit = more.where(F.size("items") > 0).select("seg", "ord", "hits", "items")
        rows = hit if rows is None else rows.unionByName(hit)
    marked = rows.groupBy("seg", "ord").agg(F.flatten(F.collect_list("hits")).alias("h"), F.flatten(F.collect_list("items")).alias("i"))
    merged = F.aggregate(
        F.array_sort("h"),
        F.array().cast("array<struct<begin:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, F.greatest(F.size(acc), F.lit(1)))["end"] >= x["begin"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["begin"].alias("begin"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    hits = cut(marked.select("seg", "ord", merged.alias("hits"), F.array_sort(F.array_distinct("i")).alias("items")), "hits")
    none = [F.array().cast(found[0].schema[c].dataType) for c in ("hits", "items")]
    return all_.join(hits, ["seg", "ord"], "left").select("doc_id", "print", "n_words", F.coalesce("hits", none[0]).alias("hits"), F.coalesce("items", none[1]).alias("items"))


def judged(found: DataFrame, part: int = 20) -> DataFrame:
    """Add n_hit and contaminated: some word is hit and hits are at least 1/``part`` of the words."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["begin"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(part) * F.col("n_hit") >= F.col("n_words"))
    )


def drop_contaminated(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; each row is judged on its own text, whatever its doc_id.

    Rows are told apart by doc_id and, under one doc_id, by a 64-bit hash of the text.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct("*").alias("row"))
    found = judged(_found(named, tests, WINDOW, True))
    gone = cut(found.where("contaminated").select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).distinct(), "contaminated")
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_print"))
    return named.join(F.broadcast(gone) if few else gone, same, "left_anti").select("row.*")


def op9(docs: DataFrame, tests: DataFrame) -> DataFrame:
    out = judged(decontaminate(docs, tests))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS g, least(13, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, greatest(1, len(w) - n + 2))) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
