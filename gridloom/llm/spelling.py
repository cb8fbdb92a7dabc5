"""Grouping of spelling variants: each word beside the commoner words one edit away.

The vocabulary is range-sorted and built into compact trie shards.  Shards are broadcast in rounds of bounded
size, and each word's distance-one automaton is intersected with every shard; what the shards
accept is reduced to a count and a best form for each word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trie
from .scratch import cut

#: Least length and occurrences of a word; how many times commoner its form has to be.
LENGTH, TIMES, FACTOR = 6, 5, 5
#: One in so many written runs loses a letter.
DROP = 199
#: Letters of a shard before prefixes are shared, and bytes of shards that a round broadcasts (or a single larger shard).
SHARD_LETTERS, ROUND_BYTES = 1 << 20, 16 << 20
#: Words of one partition, and words whose automata run side by side.
PARTITION_WORDS, BATCH = 50_000, 16_384
#: Distinct words that a task counts before it hands them on; bytes of text worked on at a time.
HELD, CHUNK = 200_000, 4 << 20

#: Single-byte letters to themselves, A-Z to a-z, all else to a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _runs(text: str) -> Iterator[list[bytes]]:
    """Runs of letters, a byte for each, of the long enough ones; a long text comes in several lists."""
    flat = text.encode("latin-1", "replace").translate(_LETTERS)
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + CHUNK) if len(flat) - at > CHUNK else len(flat)
        end = len(flat) if end < 0 else end
        yield [r for r in flat[at:end].split() if len(r) >= LENGTH]
        at = end


def _written(doc: bytes, run: bytes, drop: int) -> bytes:
    """A run as it counts: one in ``drop`` is short of a letter, by a checksum of document and run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(doc + b":"))
    if h % drop:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, drop: int = DROP) -> DataFrame:
    """word, n of all words of ``docs`` (doc_id, text) with at least LENGTH letters and TIMES occurrences.

    Counts are taken in the tasks before anything is shuffled.  Null texts have no words; a null doc_id is an empty string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                name = (doc.as_py() or "").encode()
                for runs in _runs(text.as_py() or ""):
                    for r, n in Counter(runs).items():
                        w = _written(name, r, drop)
                        if len(w) >= LENGTH:
                            total[w] += n
                    if len(total) >= HELD:
                        yield out()
                        total.clear()
        if total:
            yield out()

    words = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= TIMES)


def shards(words: DataFrame, parts: int) -> DataFrame:
    """``words`` (word, n) range-sorted into trie shards: a table of payloads."""
    ordered = words.select("word", "n").repartitionByRange(parts, "word").sortWithinPartitions("word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        counts: list[int] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([trie.build(held, np.array(counts))], pa.binary())], ["payload"])

        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(w.encode("latin-1"))
                counts.append(n)
                size += len(w)
                if size >= SHARD_LETTERS:
                    yield out()
                    held, counts, size = [], [], 0
        if held:
            yield out()

    return cut(ordered.mapInArrow(run, "payload binary"), "shards")


def _rounds(table: DataFrame) -> Iterator[list[bytes]]:
    """The shards in lists of about ROUND_BYTES, taken off the table one after the other."""
    held: list[bytes] = []
    for row in table.toLocalIterator():
        if held and sum(map(len, held)) + len(row.payload) > ROUND_BYTES:
            yield held
            held = []
        held.append(bytes(row.payload))
    if held:
        yield held


def _near(words: DataFrame, parts: int, sent: Broadcast) -> DataFrame:
    """word, n, n_near, form, form_n over the shards of one round, for words with a neighbour there.

    The words of a task are run through one shard after the other, so that a task holds one loaded shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        if not own:
            return
        table = pa.Table.from_batches(own)
        names, counts = table.column(0).combine_chunks(), table.column(1).combine_chunks()
        letters = [w.encode("latin-1") for w in names.to_pylist()]
        for t in map(trie.Trie, sent.value):
            for at in range(0, len(letters), BATCH):
                found = list(t.neighbours(letters[at:at + BATCH]))
                if not found:
                    continue
                of, to = (np.concatenate(x) for x in zip(*found))
                pairs = np.unique(of * t.words + to)
                of, to = pairs // t.words, pairs % t.words
                order = np.lexsort((to, -t.counts[to], of))  # words of a shard are numbered in their order
                of, to = of[order], to[order]
                who, first, near = np.unique(of, return_index=True, return_counts=True)
                best = to[first]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(who + at)), counts.take(pa.array(who + at)), pa.array(near), pa.array([b.decode("latin-1") for b in t.spell(best)]), pa.array(t.counts[best])],
                    ["word", "n", "n_near", "form", "form_n"],
                )

    dealt = words.select("word", "n").repartition(parts, "word")
    return dealt.mapInArrow(run, "word string, n long, n_near long, form string, form_n long")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near and best (the commonest near word and its count) of all ``words`` (word, n) that have a near word."""
    spark = words.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, words.count() // PARTITION_WORDS + 1)
    found = None
    for payloads in _rounds(shards(words, parts)):
        sent = spark.sparkContext.broadcast(payloads)
        near = cut(_near(words, parts, sent), "near")
        sent.unpersist()
        found = near if found is None else found.unionByName(near)
    if found is None:
        found = spark.createDataFrame([], "word string, n long, n_near long, form string, form_n long")
    ranked = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), ranked.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) to (word, root): forms followed to the last.

    A form is FACTOR times commoner than its word, so chains are as short as the logarithm of the largest
    count, and each round of jumps halves them.
    """
    at = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = at.join(onward, "root", "left")
        if moved.where(F.col("_next").isNotNull()).isEmpty():
            return at
        at = cut(moved.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variants(docs: DataFrame, drop: int = DROP) -> DataFrame:
    """Every word of ``docs`` (doc_id, text) with its group: word, form, root, n, n_near, form_n.

    Words are near if they differ by one letter put in, left out or replaced.  ``form`` is the commonest near
    word (the first in code-point order of equally common ones) where that is at least FACTOR times commoner, and ``root`` where
    following forms leads.  Rows repeated in full each count.  No words give no rows.
    """
    words = cut(vocabulary(docs, drop), "words")
    near = neighbours(words)
    common = -F.col("best.less")
    rows = words.join(near, "word", "left").withColumn("form_n", F.when(common >= FACTOR * F.col("n"), common))
    rows = cut(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("form_n").isNotNull(), F.col("best.form")).alias("form"), "form_n"), "forms")
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11(docs: DataFrame) -> DataFrame:
    return variants(docs)
