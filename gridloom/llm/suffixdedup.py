"""Removal of repeated 100-byte strings with sharded suffix arrays.

Which suffixes can share their first LENGTH bytes is settled by content: every window of
LENGTH bytes holds a least GRAM-byte hash (its anchor), so equal windows have equal
anchors and are dealt to the same shard.  A window whose anchor occurs once in the
corpus is unique and goes nowhere.

1. Documents equal as a whole are set aside but for the first.
2. Tasks list the anchors of their documents.  An anchor that a task meets twice is
   known there as repeated and sent on once; the others meet by hash.
3. For each repeated anchor the stretch of text with exactly the windows it anchors is
   dealt out by its hash.  A stretch met before in the same task is marked there.
4. Each shard gets a suffix array over its stretches (Larsson-Sadakane refinement: only
   groups not yet told apart are sorted again, by the rank that lies further on) and
   common prefixes in the manner of Kasai: along a diagonal they shrink by one, so each
   byte is compared once.  An anchor with more text than one suffix array takes is
   dealt over many shards; the first of each window in a shard is sent on with its
   bytes, and the shards are merged: windows are dealt over ranges small enough to keep, each
   looked up in corpus order by binary search among those before it.
5. The windows found are joined per document and their bytes taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import mix64, ranges, running_hash, slices
from .scratch import cut

LENGTH, GRAM = 100, 32
#: Bytes of text scanned at once, and of stretches in one suffix array; each takes some hundred bytes of memory for one.
SLICE_BYTES, SHARD_BYTES = 512 << 10, 512 << 10
#: Tables of at most so many rows and bytes are broadcast, larger ones joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 1 << 20
#: Bytes of text to a bucket of anchors, and entries of a task's list of anchors known as repeated.
BUCKET_BYTES, KNOWN = 8 << 20, 2_000_000


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first window, last window) of each anchor; windows are byte places in ``data``."""
    empty = np.zeros(0, np.int64)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return empty.view(np.uint64), empty, empty, empty
    sums, down = running_hash(data, False)
    grams = mix64((sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1])
    bits = np.uint64(max(24, int(len(data)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    # the leftmost of the least grams: order by hash, then by place
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, LENGTH - GRAM + 1
    while width * 2 <= wanted:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[:n], key[wanted - width:])
    at = (key & low).astype(np.int64)
    sizes = np.maximum(0, np.diff(offsets) - LENGTH + 1)
    window = ranges(offsets[:-1], sizes)
    if not len(window):
        return empty.view(np.uint64), empty, empty, empty
    at, text = at[window], np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    return grams[at[begin]], text[begin], window[begin], window[end]


def suffix_array(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all stretches in the order of their LENGTH bytes, equal ones by place, and their ranks.

    ``begins`` and ``sizes`` give the stretches of ``data``; no window leaves its stretch.
    """
    n = len(data)
    room = np.zeros(n, np.int64)
    whole = ranges(begins, sizes)
    room[whole] = np.repeat(begins + sizes, sizes) - whole
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k:n + k]
    rank = np.full(n, -1, np.int64)
    live = np.flatnonzero(room >= 8)
    live = live[np.argsort(word[live], kind="stable")]
    _regroup(rank, live, np.diff(word[live]) != 0)
    depth = 8
    for step in (8, 16, 32, LENGTH - 64):
        depth += step
        live = live[room[live] >= depth]
        # only groups of more than one are sorted again
        r = rank[live]
        many = np.zeros(len(live), bool)
        many[1:] = r[1:] == r[:-1]
        many[:-1] |= many[1:]
        pick = np.flatnonzero(many)
        rest = live[pick]
        order = np.lexsort((rest, rank[rest + step], rank[rest]))
        rest = rest[order]
        live[pick] = rest
        first, second = rank[live], np.where(many, rank[np.minimum(live + step, n - 1)], 0)
        differ = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        _regroup(rank, live, differ)
    return live, rank[live]


def _regroup(rank: np.ndarray, order: np.ndarray, differ: np.ndarray) -> None:
    """Give each position of ``order`` the place of the first of its group as rank."""
    head = np.zeros(len(order), np.int64)
    head[1:] = np.where(differ, np.arange(1, len(order)), 0)
    rank[order] = np.maximum.accumulate(head)


def common_prefix(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each window in ``order`` whether it shares LENGTH bytes with the one before it there."""
    same = np.zeros(len(order), bool)
    if len(order) < 2:
        return same
    place, before = order[1:], order[:-1]
    by = np.argsort(place, kind="stable")
    place, gap = place[by], place[by] - before[by]
    head = np.ones(len(place), bool)
    head[1:] = (place[1:] != place[:-1] + 1) | (gap[1:] != gap[:-1])
    run = np.flatnonzero(head)
    size = np.diff(np.append(run, len(place)))
    spot = ranges(place[run], size + LENGTH - 1)
    other = spot - np.repeat(gap[run], size + LENGTH - 1)
    wrong = np.concatenate(([0], np.cumsum(data[spot] != data[other])))
    start = ranges(np.concatenate(([0], np.cumsum(size + LENGTH - 1)))[:-1], size)
    found = wrong[start + LENGTH] == wrong[start]
    out = np.zeros(len(order) - 1, bool)
    out[by] = found
    same[1:] = out
    return same


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ``sizes`` bytes at ``a`` and at ``b`` are equal, for each pair."""
    if not len(a):
        return np.zeros(0, bool)
    differ = data[ranges(a, sizes)] != data[ranges(b, sizes)]
    return ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)


def _equal_before(hashes: np.ndarray, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, ranks: tuple[np.ndarray, ...] = ()) -> np.ndarray:
    """Which stretches equal an earlier one, in order of ``ranks`` or as they come.

    A hash brings equal ones side by side, their bytes decide.
    """
    sums, down = running_hash(data, False)
    print_ = mix64((sums[begins + sizes] - sums[begins]) * down[begins])
    order = np.lexsort((*ranks, sizes, print_, hashes))
    x, y = order[1:], order[:-1]
    alike = np.flatnonzero((hashes[x] == hashes[y]) & (sizes[x] == sizes[y]) & (print_[x] == print_[y]))
    again = np.zeros(len(begins), bool)
    again[x[alike]] = _same_bytes(data, begins[x[alike]], begins[y[alike]], sizes[x[alike]])
    return again


def repeats(
    hashes: np.ndarray, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, hot: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first, last) of runs of repeated windows in stretches that come by hash, then in corpus order,
    as places in the stretch, and (stretch, place, bytes) of the first of each window of the ``hot`` stretches.
    """
    stretch, again = np.arange(len(begins)), _equal_before(hashes, data, begins, sizes)
    whole, top = np.flatnonzero(again), sizes[again] - LENGTH
    if len(whole):  # each stretch goes into the suffix array once
        stretch = np.flatnonzero(~again)
        data = data[ranges(begins[stretch], sizes[stretch])]
        sizes = sizes[stretch]
        begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    live, _ = suffix_array(data, begins, sizes)
    repeated = common_prefix(data, live)
    flag = np.zeros(len(data), bool)
    flag[live[repeated]] = True
    step = np.diff(flag.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1
    own = np.searchsorted(begins, first, "right") - 1
    heads = np.sort(live[~repeated])
    owner = np.searchsorted(begins, heads, "right") - 1
    sent = hot[stretch[owner]]
    heads, owner = heads[sent], owner[sent]
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[heads] if len(heads) else np.zeros((0, LENGTH), np.uint8)
    return (
        np.concatenate([stretch[own], whole]),
        np.concatenate([first - begins[own], np.zeros(len(whole), np.int64)]),
        np.concatenate([last - begins[own], top]),
        stretch[owner],
        heads - begins[owner],
        windows,
    )


def _small(df: DataFrame, size: F.Column) -> bool:
    r = df.agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    return r["n"] <= BROADCAST_ROWS and (r["b"] or 0) <= BROADCAST_BYTES


def _anchored(docs: DataFrame, buckets: int) -> DataFrame:
    """Anchors of docs (no, text): rows (bucket, hashes, nos, ords), and with bucket null those known as repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, np.uint64)

        def rows(bucket: list, hashes: list, nos: list, ords: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(hashes, pa.binary()), pa.array(nos, pa.binary()), pa.array(ords, pa.binary())], ["bucket", "hashes", "nos", "ords"])

        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), SLICE_BYTES):
                h, text, _, _ = anchors(data, offsets)
                if not len(h):
                    continue
                no = batch.column(0)[lo:hi].to_numpy()[text]
                ordinal = (np.arange(len(h)) - np.searchsorted(text, text)).astype(np.int32)
                own, first, times = np.unique(h, return_index=True, return_counts=True)
                at = np.searchsorted(own, h)
                twice = times > 1
                if len(known):
                    seen = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
                else:
                    seen = np.zeros(len(own), bool)
                direct = (twice | seen)[at]
                if direct.any():
                    yield rows([None], [b""], [no[direct].tobytes()], [ordinal[direct].tobytes()])
                # one entry for a hash met twice (place -1: its documents are told already), none for one known before
                send = ~seen
                if len(known) < KNOWN:
                    known = np.union1d(known, own[twice & ~seen])
                h1, place = own[send], first[send]
                n1 = no[place]
                o1 = np.where(twice[send], -1, ordinal[place]).astype(np.int32)
                b = (h1 % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(b, kind="stable")
                cuts = np.flatnonzero(np.diff(b[order], prepend=-1))
                ends = np.append(cuts[1:], len(order))
                parts = [order[x:y] for x, y in zip(cuts, ends)]
                yield rows([int(b[p[0]]) for p in parts], [h1[p].tobytes() for p in parts], [n1[p].tobytes() for p in parts], [o1[p].tobytes() for p in parts])

    return cut(docs.select("no", "text").mapInArrow(run, "bucket int, hashes binary, nos binary, ords binary"), "anchors")


def _repeated(anchored: DataFrame) -> DataFrame:
    """(no, ords binary): the ordinals of each document's anchors that occur again in the corpus."""

    def meet(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"]])
        no = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["nos"]])
        o = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in table["ords"]])
        order = np.argsort(h, kind="stable")
        h, no, o = h[order], no[order], o[order]
        same = h[1:] == h[:-1]
        many = np.zeros(len(h), bool)
        many[1:] |= same
        many[:-1] |= same
        pick = many & (o >= 0)
        return pa.table({"no": no[pick], "ord": o[pick]})

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                no, o = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(no), pa.array(o)], ["no", "ord"])

    met = anchored.where(F.col("bucket").isNotNull()).groupBy("bucket").applyInArrow(meet, "no long, ord int")
    direct = anchored.where(F.col("bucket").isNull()).select("nos", "ords").mapInArrow(told, "no long, ord int")
    return cut(met.union(direct).groupBy("no").agg(F.collect_set("ord").alias("ords")), "repeated")


def _stretches(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(hash, no, first, text binary) of every repeated anchor's stretch; with text null the windows
    first .. first + n - 1 are repeated for certain."""
    small = _small(repeated, F.size("ords") * 4 + 40)
    rows = docs.select("no", "text").join(F.broadcast(repeated) if small else repeated, "no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), SLICE_BYTES):
                h, text, first, last = anchors(data, offsets)
                ords = batch.column(2)[lo:hi]
                at = np.searchsorted(text, np.arange(hi - lo))
                sizes = np.diff(ords.offsets.to_numpy())
                pick = np.sort(np.repeat(at, sizes) + ords.flatten().to_numpy())
                h, text, first, last = h[pick], text[pick], first[pick], last[pick]
                no = batch.column(0)[lo:hi].to_numpy()[text]
                length = last - first + LENGTH
                start = first - offsets[text]
                # a stretch equal to an earlier one of this slice
                full = ~_equal_before(h, data, first, length, (start, no))
                blob_len = length[full]
                bytes_ = data[ranges(first[full], blob_len)]
                offs = np.concatenate(([0], np.cumsum(np.where(full, length, 0)))).astype(np.int32)
                texts = pa.Array.from_buffers(pa.binary(), len(h), [pa.array(full).buffers()[1], pa.py_buffer(offs), pa.py_buffer(bytes_)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(no), pa.array(start), pa.array((last - first + 1).astype(np.int32)), texts], ["hash", "no", "first", "n", "text"]
                )

    return cut(rows.select("no", "text", "ords").mapInArrow(run, "hash long, no long, first long, n int, text binary"), "stretches")


def _marks(stretches: DataFrame) -> DataFrame:
    """(no, begin, end): byte ranges that repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush(rows: list) -> pa.RecordBatch:
            h, no, first, hot = (np.concatenate([r[k] for r in rows]) for k in range(4))
            sizes = np.concatenate([r[4] for r in rows])
            data = np.concatenate([r[5] for r in rows])
            begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            s, a, b, t, c, windows = repeats(h, data, begins, sizes, hot)
            begin = np.concatenate([first[s] + a, first[t] + c])
            end = np.concatenate([first[s] + b + LENGTH, first[t] + c + LENGTH])
            known = pa.array(np.arange(len(begin)) >= len(s)).buffers()[1]
            offs = np.concatenate([np.zeros(len(s), np.int32), np.arange(len(t) + 1, dtype=np.int32) * LENGTH])
            blobs = pa.Array.from_buffers(pa.binary(), len(begin), [known, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(windows))])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([no[s], no[t]])), pa.array(begin), pa.array(end), blobs], ["no", "begin", "end", "window"])

        for batch in batches:
            h, no, first = (batch.column(k).to_numpy() for k in range(3))
            hot = batch.column(3).to_numpy(zero_copy_only=False)
            blob = batch.column(4)
            offs = np.frombuffer(blob.buffers()[1], np.int32, len(blob) + 1, blob.offset * 4).astype(np.int64)
            raw = np.frombuffer(blob.buffers()[2], np.uint8)
            row = 0
            while row < len(h):
                end = max(row + 1, int(np.searchsorted(offs, offs[row] + SHARD_BYTES - size, "right")) - 1)
                end = min(end, len(h))
                part = (h[row:end], no[row:end], first[row:end], hot[row:end], np.diff(offs[row:end + 1]), raw[offs[row]:offs[end]].copy())
                held.append(part)
                size += len(part[5])
                row = end
                if size < SHARD_BYTES:
                    continue
                # cut before the last hash unless it fills the shard alone, as only a hot one can
                all_h = np.concatenate([r[0] for r in held])
                keep = int(np.searchsorted(all_h, all_h[-1]))
                if keep == 0:
                    yield flush(held)
                    held, size = [], 0
                else:
                    head, tail = _split(held, keep)
                    yield flush(head)
                    held, size = tail, sum(len(r[5]) for r in tail)
        if held:
            yield flush(held)

    found = cut(_dealt(stretches).mapInArrow(run, "no long, begin long, end long, window binary"), "found")
    told = stretches.where(F.col("text").isNull()).select("no", F.col("first").alias("begin"), (F.col("first") + F.col("n") + LENGTH - 1).alias("end"))
    return found.where(F.col("window").isNull()).drop("window").union(_merged(found.where(F.col("window").isNotNull()))).union(told)


def _merged(windows: DataFrame) -> DataFrame:
    """(no, begin, end) of every window (no, begin, end, window) of a shard that another shard has earlier.

    A range of windows, by their hash, holds about SHARD_BYTES of different ones.  A task takes
    the rows of a range in corpus order and looks each up by binary search in the sorted windows that it
    met before; only the first of each window is kept there.
    """
    n = windows.count()
    if not n:
        return windows.select("no", "begin", "end")
    ranges_ = max(1, -(-n * LENGTH // SHARD_BYTES))
    dealt = windows.withColumn("range", F.pmod(F.xxhash64("window"), F.lit(ranges_))).repartition("range").sortWithinPartitions("range", "no", "begin")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = -1, np.zeros(0, f"S{LENGTH + 1}")
        for batch in batches:
            place = batch.column(0).to_numpy()
            # one byte more, as numpy drops zero bytes at the end
            rows = np.array([bytes(x.as_buffer()) + b"\1" for x in batch.column(4)], f"S{LENGTH + 1}")
            cuts = np.flatnonzero(np.diff(place, prepend=place[:1] - 1)) if len(place) else []
            later = np.zeros(len(rows), bool)
            for a, b in zip(cuts, [*cuts[1:], len(rows)]):
                if place[a] != at:
                    at, known = place[a], known[:0]
                own, first, back = np.unique(rows[a:b], return_index=True, return_inverse=True)
                spot = np.searchsorted(known, own)
                met = np.zeros(len(own), bool)
                inside = spot < len(known)
                met[inside] = known[spot[inside]] == own[inside]
                later[a:b] = met[back] | (np.arange(b - a) != first[back])
                known = np.insert(known, spot[~met], own[~met])
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in (1, 2, 3)], ["no", "begin", "end"]).filter(pa.array(later))

    return dealt.select("range", "no", "begin", "end", "window").mapInArrow(merge, "no long, begin long, end long")


def _dealt(stretches: DataFrame) -> DataFrame:
    """(hash, no, first, hot, text): stretches with text dealt by hash, those of a hot hash over pieces of
    about SHARD_BYTES; within a task by hash, then in corpus order."""
    texts = stretches.where(F.col("text").isNotNull())
    # at most one hot hash for SHARD_BYTES of stretches
    bytes_ = F.sum(F.col("n") + F.lit(LENGTH - 1).cast("long"))
    hot = cut(texts.groupBy("hash").agg(bytes_.alias("bytes")).where(F.col("bytes") >= SHARD_BYTES).select("hash", F.ceil(F.col("bytes") / SHARD_BYTES).alias("pieces")), "hot")
    marked = texts.join(F.broadcast(hot) if _small(hot, F.lit(32)) else hot, "hash", "left")
    piece = F.coalesce(F.pmod(F.xxhash64("no", "first"), "pieces"), F.lit(0))
    dealt = marked.select("hash", "no", "first", F.col("pieces").isNotNull().alias("hot"), "text", piece.alias("piece")).repartition("hash", "piece")
    return dealt.sortWithinPartitions("hash", "no", "first").select("hash", "no", "first", "hot", "text")


def _split(held: list, at: int) -> tuple[list, list]:
    """Cut a list of column tuples after ``at`` rows."""
    head, tail = [], []
    for r in held:
        n = len(r[0])
        if at >= n:
            head.append(r)
        elif at <= 0:
            tail.append(r)
        else:
            byte = int(r[4][:at].sum())
            head.append((*(c[:at] for c in r[:5]), r[5][:byte]))
            tail.append((*(c[at:] for c in r[:5]), r[5][byte:]))
        at -= n
    return head, tail


def _numbered(docs: DataFrame) -> DataFrame:
    """Add ``no``, unique and ascending with (doc_id, text): the doc_id itself where it can serve."""
    n = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("k"), F.count_distinct("doc_id").alias("d")).first()
    if n["n"] == n["k"] == n["d"]:
        return docs.withColumn("no", F.col("doc_id").cast("long"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield batch.append_column("no", pa.array(np.arange(at, at + batch.num_rows)))
            at += batch.num_rows

    key = F.col("doc_id").asc_nulls_first()
    placed = docs.repartitionByRange(key, F.xxhash64("text")).sortWithinPartitions(key, F.xxhash64("text"))
    return cut(placed.mapInArrow(number, "doc_id long, text string, no long"), "numbered")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Take out of every text each byte that a LENGTH-byte string starting earlier in the corpus covers.

    One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, spans
    array<struct<begin,end>> (maximal removed byte ranges), kept binary.

    Earlier means a smaller doc_id, or an earlier start in the same document.  A null
    text is empty.  A null doc_id comes before all others; rows of one doc_id follow
    each other in the order of a hash of their texts.  Texts under LENGTH bytes stay whole.
    """
    rows = _numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    prints = cut(rows.where(F.octet_length("text") >= LENGTH).select("no", F.octet_length("text").alias("n"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "prints")
    same = cut(prints.groupBy("sha", "n").agg(F.min("no").alias("first"), F.count("*").alias("c")).where(F.col("c") > 1), "same")
    copies = cut(prints.join(same, ["sha", "n"]).where(F.col("no") != F.col("first")).select("no", "n"), "copies")
    few = _small(copies, F.lit(40))
    fresh = rows.where(F.octet_length("text") >= LENGTH).join(F.broadcast(copies.select("no")) if few else copies.select("no"), "no", "left_anti")
    total = prints.agg(F.sum("n")).first()[0] or 0
    repeated = _repeated(_anchored(fresh, max(16, total // BUCKET_BYTES)))
    marks = _marks(_stretches(fresh, repeated))
    whole = copies.select("no", F.lit(0).cast("long").alias("begin"), F.col("n").cast("long").alias("end"))
    by_doc = cut(marks.union(whole).groupBy("no").agg(F.collect_list(F.struct("begin", "end")).alias("marks")), "marks")
    small = _small(by_doc, F.size("marks") * 16 + 64)
    joined = rows.join(F.broadcast(by_doc) if small else by_doc, "no", "left")

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), SLICE_BYTES):
                cover = np.zeros(len(data) + 1, np.int32)
                for i, m in enumerate(batch.column(2)[lo:hi]):
                    if m.is_valid:
                        begin, end = m.values.flatten()
                        np.add.at(cover, offsets[i] + begin.to_numpy(), 1)
                        np.add.at(cover, offsets[i] + end.to_numpy(), -1)
                gone = np.cumsum(cover[:-1]) > 0
                step = np.zeros(len(gone), bool)
                step[1:] = gone[1:] & ~gone[:-1]
                edge = offsets[:-1][offsets[:-1] < len(data)]
                step[edge] = gone[edge]
                begin = np.flatnonzero(step)
                stop = np.zeros(len(gone), bool)
                stop[:-1] = gone[:-1] & ~gone[1:]
                edge = offsets[1:][offsets[1:] > 0] - 1
                stop[edge] = gone[edge]
                end = np.flatnonzero(stop) + 1
                doc = np.searchsorted(offsets, begin, "right") - 1
                spans = pa.ListArray.from_arrays(
                    np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32),
                    pa.StructArray.from_arrays([pa.array(begin - offsets[doc]), pa.array(end - offsets[doc])], ["begin", "end"]),
                )
                left = np.concatenate(([0], np.cumsum(~gone)))
                kept = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(left[offsets].astype(np.int32)), pa.py_buffer(data[~gone])])
                size = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(size), pa.array(size - np.diff(left[offsets])), spans, kept], ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
                )

    return joined.select("doc_id", "text", "marks").mapInArrow(
        strike, "doc_id long, n_bytes long, n_removed long, spans array<struct<begin:bigint,end:bigint>>, kept binary"
    )


def op5(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

