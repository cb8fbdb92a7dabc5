"""MinHash near-duplicates by a multi-index Hamming join.

Every document gets a signature of K symbols of b = 16 bits, one for each minhash.
The signature is split into CHUNKS chunks.  Two signatures that differ in at most
``(ERRORS + 1) * CHUNKS - 1`` symbols differ in at most ERRORS symbols of some chunk
(pigeonhole); each document is filed under every way to leave ERRORS symbols of a
chunk out, so such a pair meets in a bucket for certain.  With 64 symbols, 16 chunks
and one error that distance is 31; at a similarity of 0.75 the distance has mean 16 and
standard deviation 3.5.

Documents with equal shingle sets are joined first and searched once.  In a bucket every
document is paired with the least id; what those links leave apart is compared in a
second pass, so that no bucket is expanded into all its pairs and none is capped.  Pairs
become links only on their full shingle sets.  Before that a parity sketch of each set
(bit h mod m says whether an odd number of shingles fall there) bounds the number of
shingles that only one of two sets has from below, so no pair is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import mix64, ranges, slices, word_hashes, words
from .components import components, extend
from .scratch import cut

SHINGLE = 5
K, CHUNKS, ERRORS = 64, 16, 1
REACH = (ERRORS + 1) * CHUNKS - 1
#: Ids are broadcast up to this many, about 32 MB; above it the join is shuffled.
BROADCAST_IDS = 1_000_000
#: Buckets that hold more than a ten-thousandth of all filings are dealt out over SALTS tasks.
SALTS, SAMPLE = 64, 128
#: In the second pass, buckets larger than SMALL are compared block by block.
SMALL, BLOCK = 24, 256


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin (n + 1)."""
    starts, ends, first = words(data, offsets, "blank")
    h = word_hashes(data, starts, ends)
    sizes = np.diff(first)
    factor = np.cumprod(np.array([1] + [0xA24BAED4963EE407] * (SHINGLE - 1), np.uint64), dtype=np.uint64)
    rolled = h.copy()
    for j in range(1, SHINGLE):
        rolled[:len(h) - j] += h[j:] * factor[j]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    for i in short:  # the whole sequence as one
        own = h[first[i]:first[i + 1]]
        rolled[first[i]] = (own * factor[:len(own)]).sum(dtype=np.uint64) ^ np.uint64(sizes[i])
    count = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, (sizes > 0).astype(np.int64))
    values = mix64(rolled[ranges(first[:-1], count)])
    text = np.repeat(np.arange(len(sizes)), count)
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(len(sizes) + 1))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(75)
    return rng.integers(0, 1 << 63, K, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, K, np.uint64)


def _binary(rows: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Equal-length byte rows as a binary array, null where not valid."""
    width = rows.shape[1] * rows.itemsize if rows.ndim > 1 else rows.itemsize
    lengths = np.where(valid, width, 0)
    offs = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    mask = pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(valid), [mask, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(rows[valid] if len(rows) == len(valid) else rows))])


def parities(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Parity sketches of sets as binary: about four bits for each shingle, a power of two and 256 at least."""
    n = np.diff(first)
    bits = np.left_shift(1, np.maximum(8, np.ceil(np.log2(np.maximum(1, 4 * n))).astype(np.int64)))
    start = np.concatenate(([0], np.cumsum(bits)))
    place = np.repeat(start[:-1], n) + (values & (np.repeat(bits, n) - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=start[-1]) & 1).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((start >> 3).astype(np.int32)), pa.py_buffer(np.packbits(odd, bitorder="little"))])


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches (last axis: bytes) brought down to ``size`` bytes: the parity of places equal modulo the smaller size."""
    return np.bitwise_xor.reduce(sketch.reshape(*sketch.shape[:-1], -1, size), axis=-2)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least so many elements stand in one of two sets only; ``b`` may hold several sketches of one size."""
    size = min(a.shape[-1], b.shape[-1])
    return np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(axis=-1, dtype=np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp1, fp2 (fingerprint of the set), sig binary (K symbols; null for an empty set),
    parity binary (see :func:`parities`)."""
    a, b = _coefficients()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1)):
                values, first = shingle_sets(data, offsets)
                n = np.diff(first)
                full = n > 0
                at = first[:-1][full]
                fp = np.zeros((2, len(n)), np.uint64)
                sig = np.zeros((int(full.sum()), K), np.uint16)
                if len(at):
                    fp[0, full] = np.add.reduceat(mix64(values ^ np.uint64(0x1F83D9AB)), at)
                    fp[1, full] = np.add.reduceat(mix64(values ^ np.uint64(0x5BE0CD19)), at)
                    for k in range(K):
                        least = np.minimum.reduceat(values * a[k] + b[k], at)
                        sig[:, k] = (mix64(least) >> np.uint64(48)).astype(np.uint16)
                whole = np.zeros((len(n), K), np.uint16)
                whole[full] = sig
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(n.astype(np.int64)), pa.array(fp[0].view(np.int64)), pa.array(fp[1].view(np.int64)), _binary(whole, full), parities(values, first)],
                    ["doc_id", "n_shingles", "fp1", "fp2", "sig", "parity"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, sig binary, parity binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column without nulls, one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
    start = np.frombuffer(column.buffers()[1], np.int32, 1, column.offset * 4)[0] if len(column) else 0
    return raw[start:start + len(column) * 2 * K].view(np.uint16).reshape(-1, K)


def filings(sig: np.ndarray) -> np.ndarray:
    """Bucket keys of signatures: for every chunk and every symbol left out the others, exactly."""
    wide = K // CHUNKS
    parts = sig.reshape(len(sig), CHUNKS, wide).astype(np.int64)
    keys = np.empty((len(sig), CHUNKS, wide), np.int64)
    for gone in range(wide):
        key = np.zeros((len(sig), CHUNKS), np.int64)
        for s in range(wide):
            if s != gone:
                key = key << 16 | parts[:, :, s]
        keys[:, :, gone] = key | (np.arange(CHUNKS) * wide + gone) << 48
    return keys.reshape(len(sig), -1)


def _filed(reps: DataFrame, hot: np.ndarray) -> DataFrame:
    """(key, salt, id) of every filing; salt is -1 but for hot keys."""
    shared = reps.sparkSession.sparkContext.broadcast(np.sort(hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = filings(_matrix(part.column(1))).ravel()
                ids = np.repeat(part.column(0).to_numpy(), CHUNKS * (K // CHUNKS))
                salt = np.full(len(ids), -1, np.int32)
                if len(crowded):
                    place = np.minimum(np.searchsorted(crowded, keys), len(crowded) - 1)
                    on = crowded[place] == keys
                    salt[on] = (mix64(ids[on].astype(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(salt), pa.array(ids)], ["key", "salt", "id"])

    return reps.select("doc_id", "sig").mapInArrow(run, "key long, salt int, id long")


def _leaders(filed: DataFrame) -> DataFrame:
    """(key, salt, leader, id): each document of a bucket with its least id, which sorting
    brings first.  Buckets of one document give no row unless their key is salted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key0 = salt0 = lead0 = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, salt, ids = (batch.column(k).to_numpy() for k in range(3))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            new[0] = (key[0], salt[0]) != (key0, salt0)
            begin = np.flatnonzero(new)
            lead = np.empty(len(key), np.int64)
            if not new[0]:
                begin = np.concatenate(([0], begin))
            sizes = np.diff(np.append(begin, len(key)))
            head = ids[begin].copy()
            if not new[0]:
                head[0] = lead0
            lead = np.repeat(head, sizes)
            key0, salt0, lead0 = key[-1], salt[-1], lead[-1]
            out = (lead != ids) | ((salt >= 0) & new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[out]), pa.array(salt[out]), pa.array(lead[out]), pa.array(ids[out])], ["key", "salt", "leader", "id"]
            )

    dealt = filed.repartition("key", "salt").sortWithinPartitions("key", "salt", "id")
    return dealt.mapInArrow(run, "key long, salt int, leader long, id long")


def _close(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parities allow the similarity and whose signatures are within reach, with their distance."""
    left = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"), F.col("parity").alias("pa"))
    right = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"), F.col("parity").alias("pb"))
    sized = (F.col("na") * percent <= F.col("nb") * 100) & (F.col("nb") * percent <= F.col("na") * 100)
    both = pairs.join(left, "a").join(right, "b").where(sized)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(axis=1)
            most = (batch.column(4).to_numpy() + batch.column(5).to_numpy()) * (100 - percent) // (100 + percent)
            near = d <= REACH
            for i in np.flatnonzero(near):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint8) for k in (6, 7))
                near[i] = differing(x, y) <= most[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d.astype(np.int32))], ["a", "b", "d"]).filter(pa.array(near))

    return both.select("a", "b", "sa", "sb", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long, d int")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, grams binary: the full shingle sets of the documents named in ``ids`` (doc_id)."""
    ids = cut(ids.distinct(), "needed")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1)):
                values, first = shingle_sets(data, offsets)
                blob = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((first * 8).astype(np.int32)), pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], blob], ["doc_id", "grams"])

    return cut(rows.mapInArrow(run, "doc_id long, grams binary"), "sets")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                same = int(np.count_nonzero(y[at] == x))
                good.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return cut(both.select("a", "b", "ga", "gb").mapInArrow(run, "a long, b long"), "links")


def _apart(members: DataFrame, comps: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, that share a bucket but no component: what the links to leaders left open."""
    own = members.join(comps, members["id"] == comps["node"], "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    own = cut(own, "placed")
    stat = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
    mixed = cut(stat.where(F.col("lo") != F.col("hi")).select("key", "size"), "mixed")
    rows = cut(own.join(mixed, "key"), "open")
    small = rows.where(F.col("size") <= SMALL)
    x, y = small.select("key", F.col("id").alias("a"), F.col("comp").alias("ca")), small.select("key", F.col("id").alias("b"), F.col("comp").alias("cb"))
    pairs = x.join(y, "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))).select("a", "b")
    large = rows.where(F.col("size") > SMALL)
    if large.isEmpty():
        return pairs.distinct()
    # every two blocks of a bucket meet in one task
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = large.join(reps.select(F.col("doc_id").alias("id"), "n_shingles", "sig", "parity"), "id").withColumn("n", blocks)
    large = large.withColumn("i", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    large = large.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    large = large.select("key", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), "i", "id", "comp", "n_shingles", "sig", "parity")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf[pdf["i"] == pdf["p"]], pdf[pdf["i"] == pdf["q"]]
        filing = int(pdf["key"].iloc[0]) >> 48
        s, t = (np.frombuffer(b"".join(map(bytes, f["sig"])), np.uint16).reshape(-1, K) for f in (p, q))
        ids, comp, size = (q[c].to_numpy() for c in ("id", "comp", "n_shingles"))
        parity = [np.frombuffer(bytes(x), np.uint8) for x in q["parity"]]
        groups = [(rows := np.array([i for i, x in enumerate(parity) if len(x) == w]), np.stack([parity[i] for i in rows])) for w in {len(x) for x in parity}]
        found = [np.zeros((0, 2), np.int64)]
        for a, ca, na, own, row in zip(p["id"], p["comp"], p["n_shingles"], p["parity"], s):
            own = np.frombuffer(bytes(own), np.uint8)
            for rows, sketch in groups:
                hit = (comp[rows] != ca) & (differing(own, sketch) * (100 + percent) <= (size[rows] + na) * (100 - percent))
                hit = rows[hit]
                equal = t[hit] == row
                hit, equal = hit[good := (~equal).sum(axis=1) <= REACH], equal[good]
                # a pair that shares several buckets is made in the first of them
                parts = equal.reshape(len(hit), CHUNKS, K // CHUNKS)
                chunk = (parts.sum(axis=2) >= K // CHUNKS - ERRORS).argmax(axis=1)
                gone = (~parts[np.arange(len(hit)), chunk]).argmax(axis=1)
                hit = hit[chunk * (K // CHUNKS) + gone == filing]
                found.append(np.stack([np.minimum(a, ids[hit]), np.maximum(a, ids[hit])], 1))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    return pairs.union(large.groupBy("key", "p", "q").applyInPandas(compare, "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Near-duplicate groups of ``docs`` (doc_id, text).

    One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable
    over links), kept (doc_id = component_id).

    Null and empty texts have no shingles, link with nothing and are kept.  Rows with
    a null doc_id cannot be named by a link: component null, kept.  Rows that share a
    doc_id count as one document with the links of all of them (those without shingles stand apart).
    An empty table gives no rows.
    """
    s = cut(sketches(docs), "sketches")
    named = s.where(F.col("doc_id").isNotNull() & F.col("sig").isNotNull())
    classes = cut(
        named.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("sig", "parity"), "doc_id").alias("s")), "classes"
    )
    reps = classes.select(F.col("rep").alias("doc_id"), "n_shingles", "s.sig", "s.parity")
    members = _buckets(reps)
    pairs = members.where(F.col("leader") != F.col("id")).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    near = cut(_close(pairs, reps, percent), "near")
    sets = _sets(docs, near.select(F.explode(F.array("a", "b")).alias("doc_id")))
    best = cut(near.groupBy("b").agg(F.min_by("a", F.struct("d", "a")).alias("a")).select("a", "b"), "best")
    comps = components(_confirm(best, sets, percent))
    comps = extend(comps, _same_document(named, classes))

    def across(pairs: DataFrame) -> DataFrame:
        c = comps.select(F.col("id").alias("node"), "component")
        p = pairs.join(c.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        p = p.join(c.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        return p.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    rest = near.select("a", "b").join(best, ["a", "b"], "left_anti")
    comps = extend(comps, _confirm(across(rest), sets, percent))
    filed = members.select("key", "id").union(members.select("key", F.col("leader").alias("id"))).distinct()
    rest = _apart(filed, comps.select(F.col("id").alias("node"), "component"), reps, percent)
    rest = cut(_close(rest.join(near, ["a", "b"], "left_anti"), reps, percent), "rest")
    if not rest.isEmpty():
        more = _sets(docs, rest.select(F.explode(F.array("a", "b")).alias("doc_id")))
        comps = extend(comps, _confirm(rest, more, percent))
    out = s.join(classes.select("fp1", "fp2", "n_shingles", "rep"), ["fp1", "fp2", "n_shingles"], "left")
    out = out.join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    group = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"))


def _same_document(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of texts that stand under one doc_id."""
    texts = F.struct("fp1", "fp2", "n_shingles")
    several = named.groupBy("doc_id").agg(F.min(texts).alias("lo"), F.max(texts).alias("hi")).where(F.col("lo") != F.col("hi"))
    several = cut(several.select("doc_id"), "several")
    rows = named.join(several, "doc_id").join(classes.select("fp1", "fp2", "n_shingles", "rep"), ["fp1", "fp2", "n_shingles"]).select("doc_id", "rep").distinct()
    least = rows.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return rows.join(least, "doc_id").where(F.col("a") != F.col("rep")).select("a", F.col("rep").alias("b")).distinct()


def _buckets(reps: DataFrame) -> DataFrame:
    """(key, leader, id) of every bucket with two documents or more, written out."""
    n = reps.count()
    least = max(32, n // SAMPLE * K // 10_000)
    sampled = reps.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    crowded = _filed(sampled, np.zeros(0, np.int64)).groupBy("key").count().where(F.col("count") >= least)
    hot = crowded.select("key").toPandas()["key"].to_numpy(np.int64)
    led = cut(_leaders(_filed(reps, hot)), "buckets")
    if not len(hot):
        return led.select("key", "leader", "id")
    heads = led.where(F.col("salt") >= 0).select("key", F.col("leader").alias("id")).distinct()
    least_id = heads.groupBy("key").agg(F.min("id").alias("leader"))
    over = heads.join(least_id, "key").select("key", "leader", "id")
    return cut(led.select("key", "leader", "id").union(over).where(F.col("leader") != F.col("id")), "buckets")


def op8(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one of the smallest doc_id (a null one last).

    Rows repeated in full are a group, with an id and without, whatever their text; so of rows that
    share a doc_id all but one go where their texts are near-duplicates, and no other.
    """
    name = F.col("doc_id").cast("long").alias("doc_id")
    odd = docs.select(name).groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("doc_id").isNull() | (F.col("n") > 1))
    if odd.isEmpty():
        found = near_duplicates(docs.select("doc_id", "text"))
        gone = cut(found.where(~F.col("kept")).select("doc_id").distinct(), "gone")
        few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        rows = docs.select(F.struct("*").alias("_row"), name)
        return rows.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select("_row.*")
    # ids don't tell rows apart, so rows are numbered and the numbers are the ids
    numbered = cut(docs.select(F.struct("*").alias("_row"), name, F.monotonically_increasing_id().alias("_no"), F.sha2("text", 256).alias("_text")), "numbered")
    found = near_duplicates(numbered.select(F.col("_no").alias("doc_id"), F.col("_row.text").alias("text")))
    met = found.select(F.col("doc_id").alias("_no"), "n_shingles", "component_id").join(numbered.select("_no", "doc_id", "_text"), "_no")
    bare = F.col("n_shingles") == 0
    group = [F.when(~bare, F.col("component_id")).alias("g"), F.when(bare, F.col("doc_id")).alias("d"), F.when(bare, F.col("_text")).alias("t")]
    first = met.groupBy(*group).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_no")).alias("_least"))
    kept = cut(first.select(F.col("_least._no").alias("_no")), "kept")
    return numbered.join(kept, "_no", "left_semi").select("_row.*")


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS id, doc_id AS root FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
