"""Token-ID files: concatenated ids with Elias-Fano document boundaries.

A corpus is a table of segments in document order.  Each segment is one blob:

    magic "GLTK", u8 version, u8 bytes per id, u16 zero, u64 ids, u32 bytes of boundaries
    boundaries: Elias-Fano of the end offset of every document, with its select samples
    ids, little-endian, 2 bytes where the vocabulary allows it, else 4

Segments are rows of a Parquet table (binary column ``payload``), which is what lets
executors write and read them on any file system Spark knows.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import eliasfano
from .scratch import cut

_HEAD = struct.Struct("<4sBBHQI")
MAGIC, VERSION = b"GLTK", 2
#: A segment is closed when it holds so many ids; a longer document makes a longer one.
SEGMENT_IDS = 1 << 20
#: Bytes of text for each range partition, and the most partitions (their offsets are broadcast).
PARTITION_BYTES, MOST_PARTITIONS = 24 << 20, 50_000
#: A worker keeps the ids of so many pieces, and of so many that it met before these.
CACHE_WORDS = 300_000

# White space as the byte-level pre-tokenizer's \s knows it (Unicode White_Space).
_W = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_L, _P = r"A-Za-z0-9À-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~"
#: The pre-tokenizer never joins what this splits: a run of letters and digits from the punctuation behind
#: it, a run of non-blanks with one space before it, and runs of white space short of that space.  The first branch
#: takes words before blanks too, as the second would, so that most text is gone over once.
_PIECES = re.compile(rf" ?[{_L}]++(?![^{_P}{_W}])| ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
#: Texts are split together up to so many characters; a longer one is split by and by.
CHUNK = 2 << 20
#: So many new pieces are encoded in one text, a line each.
_LINES = 200
#: Rows taken out of Arrow at a time.
_ROWS = 1024


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file, each distinct piece encoded once.

    Byte-level BPE merges inside pre-tokens only, so the ids of a text are those of
    its pieces in order; pieces repeat far more than texts do.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        # added tokens are found in a text before it is split; one that holds any is encoded as a whole
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values() if t.content]
        self.size = self.model.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Encode pieces not met before.

        Pieces without white space share a text, one to a line: a line end between them is
        always a pre-token, hence an id, of its own.
        """
        lines, width, learned = [], self.dtype.itemsize, {}
        for p in pieces:
            if p[1:].isspace() or p.isspace() or not p.isprintable():
                learned[p] = self._ids(p).tobytes()
            else:
                lines.append(p)
        line_end = self._ids("\n")
        parts = [lines[i:i + _LINES] for i in range(0, len(lines), _LINES)]
        # the fast form gives the same ids without the places in the text
        for part, got in zip(parts, self.model.encode_batch_fast(["\n".join(p) + "\n" for p in parts], add_special_tokens=False)):
            ids = np.array(got.ids, self.dtype)
            ends = np.flatnonzero(ids == line_end[0]).tolist() if len(line_end) == 1 else []
            if len(ends) != len(part):
                learned.update((p, self._ids(p).tobytes()) for p in part)
                continue
            blob, start = ids.tobytes(), 0
            for p, end in zip(part, ends):
                learned[p] = blob[start * width:end * width]
                start = end + 1
        return learned

    def _look_up(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of all ``pieces`` and of others.  When the pieces kept are too many they become the older ones, and the
        older ones not met since are forgotten."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        # whole sets are told apart, not pieces one by one: nearly all are known
        older, fresh = self.older, pieces.difference(self.known)
        self.known |= (met := {p: older[p] for p in fresh if p in older})
        self.known |= self._learn([*fresh.difference(met)])
        return self.known

    def _long(self, text: str) -> bytes:
        """The ids of a text that is worked off piece after piece, so that its pieces are never held together."""
        out, pieces = [], (m.group() for m in _PIECES.finditer(text))
        while part := list(itertools.islice(pieces, CHUNK // 8)):
            ids = self._look_up(set(part))
            out.append(b"".join(map(ids.__getitem__, part)))
        return b"".join(out)

    def texts(self, texts: list[str], end_id: int) -> list[bytes]:
        """The id bytes of each text, each with the end id behind it."""
        tail = np.array([end_id], self.dtype).tobytes()
        out = []
        for part in chunks(texts, CHUNK):
            whole = {i for i, t in enumerate(part) if any(a in t for a in self.added)}
            long = {i for i, t in enumerate(part) if len(t) > CHUNK} - whole
            split = [[] if i in whole or i in long else _PIECES.findall(t) for i, t in enumerate(part)]
            ids = self._look_up(set().union(*split))
            for i, (t, p) in enumerate(zip(part, split)):
                out.append((self._ids(t).tobytes() if i in whole else self._long(t) if i in long else b"".join(map(ids.__getitem__, p))) + tail)
        return out


def chunks(texts: list[str], size: int) -> Iterator[list[str]]:
    """Runs of texts that end with the one that brings them to ``size`` characters."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(docs: list[bytes], width: int) -> bytes:
    ends = np.cumsum([len(d) // width for d in docs])
    bounds = eliasfano.encode(ends)
    return _HEAD.pack(MAGIC, VERSION, width, 0, int(ends[-1]) if len(docs) else 0, len(bounds)) + bounds + b"".join(docs)


class Segment:
    """A read view of a payload: ``document(i)`` gives the ids of its i-th document."""

    def __init__(self, payload: bytes):
        magic, version, width, _, self.n_ids, n_bounds = _HEAD.unpack_from(payload, 0)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token segment")
        view = memoryview(payload)
        self.ends = eliasfano.Sequence(view[_HEAD.size:_HEAD.size + n_bounds])
        self.ids = np.frombuffer(view[_HEAD.size + n_bounds:], "<u2" if width == 2 else "<u4")

    def bounds(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of documents ``first`` .. ``last`` - 1, by select."""
        ends = self.ends.select(max(0, first - 1), last)
        return (ends[:-1], ends[1:]) if first else (np.concatenate(([0], ends[:-1])), ends)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i, i + 1)
        return self.ids[start[0]:end[0]]


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into segments and return the written table.

    Columns: part, seg (order of the corpus), first_id (ids of the part before the
    segment), n_ids, doc_ids array<bigint>, payload binary.

    Documents follow doc_id ascending, null ids first; equal ids by a hash of the text.  A null text is
    empty and still gets its end id.  Rows repeated in full are each written.  Rows without an id, or of one
    id, are spread over as many parts as any others.  An empty table gives no segment.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(MOST_PARTITIONS, max(spark.sparkContext.defaultParallelism, total // PARTITION_BYTES + 1)))
    # rows of one id, or of none, are dealt by their texts, and equal rows by a number
    rows = rows.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), "_text", "_row"]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width, part = enc.dtype.itemsize, TaskContext.get().partitionId()
        held: list[bytes] = []
        ids: list[int | None] = []
        seg, first, size = 0, 0, 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([first], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([pack(held, width)], pa.binary())],
                ["part", "seg", "first_id", "n_ids", "doc_ids", "payload"],
            )

        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for at in range(0, len(texts), _ROWS):
                for key, blob in zip(names[at:at + _ROWS].to_pylist(), enc.texts(texts[at:at + _ROWS].to_pylist(), end_id)):
                    held.append(blob)
                    ids.append(key)
                    size += len(blob) // width
                    if size >= SEGMENT_IDS:
                        yield close()
                        seg, first, size = seg + 1, first + size, 0
                        held.clear()
                        ids = []
        if held:
            yield close()

    schema = "part int, seg int, first_id long, n_ids long, doc_ids array<bigint>, payload binary"
    return cut(ordered.mapInArrow(run, schema), "tokens")


def read_tokens(segments: DataFrame) -> DataFrame:
    """Read segments back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The offsets of parts, at most MOST_PARTITIONS rows, are broadcast; places inside a
    part come with the segments.
    """
    sums = segments.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("part_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                s = Segment(batch.column(3)[row].as_py())
                names, before = batch.column(2)[row].values, batch.column(1)[row].as_py()
                for first in range(0, len(s.ends), eliasfano.SAMPLE):
                    last = min(first + eliasfano.SAMPLE, len(s.ends))
                    starts, ends = s.bounds(first, last)
                    sums_ = [zlib.crc32(s.ids[a:b].astype("<u4")) for a, b in zip(starts, ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(last - first, batch.column(0)[row].as_py(), np.int32)), names[first:last],
                         pa.array(starts + before), pa.array(ends - starts), pa.array(sums_, pa.int64())],
                        ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    docs = segments.select("part", "first_id", "doc_ids", "payload").mapInArrow(
        run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    placed = docs.join(F.broadcast(offsets), "part")
    return placed.select("doc_id", (F.col("start") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4(docs: DataFrame) -> DataFrame:
    return read_tokens(write_tokens(docs, default_tokenizer()))


def load_segment(spark: SparkSession, path: str) -> DataFrame:
    """A token corpus written elsewhere (the table that :func:`write_tokens` made)."""
    return spark.read.parquet(path)
