"""Packing of documents into training sequences along a space-filling curve.

Each document's hashed word vector is projected to a few dimensions, and documents are range-sorted
by the place of that point on a Hilbert curve.  Neighbours on the curve have like words, so a sequence
holds documents that are like each other.  Inside a range documents are laid end to end and cut
every ``size`` ids; what is left at the end of a range is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import bytescan, hilbert
from .scratch import cut
from .tokens import _ROWS, MOST_PARTITIONS, PARTITION_BYTES, chunks

#: Buckets of the hashed vector, dimensions it is projected to, bits of each.
BUCKETS, DIMENSIONS, BITS = 1 << 16, 4, 15
#: A worker keeps the ids of so many pieces and parts of pieces, and of so many that it met before these; longer ones are not kept.
CACHE_WORDS, LONG_WORD = 300_000, 256
#: Bytes of text split at a time, and sequences written at a time.
CHUNK, BATCH = 2 << 20, 256
#: Parts encoded in one text.
_LINE = 200
_BLANK = b" \t\n\v\f\r"


def _projection() -> np.ndarray:
    return np.random.default_rng(13).integers(0, 2, (DIMENSIONS, BUCKETS), np.int8) * np.int8(2) - np.int8(1)


_signs: list[np.ndarray] = []


@F.arrow_udf(LongType())
def curve_key(texts: pa.Array) -> pa.Array:
    """Place on the curve of each text.  A text without words lies in the middle of the space."""
    if not _signs:
        _signs.append(_projection())
    out = []
    for _, _, data, offsets in bytescan.slices(texts):
        starts, ends, first = bytescan.words(data, offsets, "alnum")
        hashes = bytescan.word_hashes(data, starts, ends)
        # the projection of a vector of word counts is the sum of the projections of its words
        buckets = (hashes % np.uint64(BUCKETS)).astype(np.int64)
        sums = np.zeros((len(starts) + 1, DIMENSIONS), np.int32)
        for axis in range(DIMENSIONS):
            np.cumsum(_signs[0][axis][buckets], dtype=np.int32, out=sums[1:, axis])
        mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(1, np.diff(first))[:, None]
        out.append(hilbert.keys(((mean + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64), BITS))
    return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))


class _Aged:
    """A dict of two ages: when it is full its entries become the older ones, and older ones not met since are forgotten."""

    def __init__(self) -> None:
        self.new: dict = {}
        self.old: dict = {}

    def missing(self, wanted: set) -> list:
        """What of ``wanted`` is not held; what is held counts as met."""
        if len(self.new) > CACHE_WORDS:
            self.new, self.old = {}, self.new
        new, old, out = self.new, self.old, []
        for w in wanted:
            if w not in new:
                if (ids := old.get(w)) is None:
                    out.append(w)
                else:
                    new[w] = ids
        return out


#: Pieces of these letters, in which neither composition nor letter case has a special rule, are split into the tokenizer's
#: own parts here (fixed values: its pattern), which recur far more than pieces do.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space and merges inside words only.

    Nothing of such a tokenizer reaches over ASCII white space, so the ids of a text are those of its
    blank-separated pieces in order; each distinct piece is encoded once while it is kept, and so is each part of pieces.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        # the same model without the steps that are done to parts before
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.model.model.end_of_word_suffix or "\0"
        self.last = np.zeros(self.model.get_vocab_size(), bool)
        self.last[[k for t, k in self.model.get_vocab().items() if t.endswith(suffix)]] = True
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content.encode() for t in self.model.get_added_tokens_decoder().values() if t.content]
        self.pieces, self.parts = _Aged(), _Aged()

    def _encode(self, texts: list[str]) -> list[bytes]:
        got = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in got]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of lower-case parts, many to a text: the last id of each part, and no other, is one that ends a word."""
        out: list[bytes] = []
        lines = [parts[i:i + _LINE] for i in range(0, len(parts), _LINE)]
        for line, got in zip(lines, self.bare.encode_batch_fast([" ".join(p) for p in lines], add_special_tokens=False)):
            ids = np.array(got.ids, self.dtype)
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(ends) != len(line) or (ends and ends[-1] != len(ids)):
                out += self._encode(line)
                continue
            blob, width = ids.tobytes(), self.dtype.itemsize
            out += [blob[a * width:b * width] for a, b in zip([0, *ends], ends)]
        return out

    def _learn(self, fresh: list[bytes]) -> dict[bytes, bytes]:
        texts = [p.decode() for p in fresh]
        plain = [_PARTS.findall(t.lower()) if len(t) <= LONG_WORD and _PLAIN.fullmatch(t) else None for t in texts]
        everything = b" ".join(fresh)
        if any(a in everything for a in self.added):
            plain = [None if any(a in p for a in self.added) else parts for p, parts in zip(fresh, plain)]
        wanted = {x for parts in plain if parts for x in parts}
        new = self.parts.missing(wanted)
        known = self.parts.new
        known.update(zip(new, self._encode_parts(new)))
        rest = [k for k, parts in enumerate(plain) if parts is None]
        whole = dict(zip(rest, self._encode([texts[k] for k in rest])))
        return {p: whole[k] if parts is None else b"".join(map(known.__getitem__, parts)) for k, (p, parts) in enumerate(zip(fresh, plain))}

    def _ids(self, texts: list[list[bytes]]) -> list[bytes]:
        """Ids of texts, each given by its pieces."""
        learned = self._learn(self.pieces.missing(set().union(*texts)))
        known, long = self.pieces.new, {}
        for p, ids in learned.items():
            (known if len(p) <= LONG_WORD else long)[p] = ids
        look = {**known, **long} if long else known
        return [b"".join(map(look.__getitem__, pieces)) for pieces in texts]

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The id bytes of each text.  Some megabytes of texts are worked off together; a longer text by and by."""
        out: list[bytes] = []
        for part in chunks(texts, CHUNK):
            if len(part[-1]) > CHUNK:
                out += self._ids([t.split() for t in part[:-1]])
                out.append(b"".join(self._ids([x.split()])[0] for x in _sliced(part[-1])))
            else:
                out += self._ids([t.split() for t in part])
        return out


def _sliced(text: bytes) -> Iterator[bytes]:
    """A long text in slices that end before a blank."""
    at = 0
    while at < len(text):
        end = min((e for b in _BLANK if (e := text.find(b, at + CHUNK)) >= 0), default=len(text))
        yield text[at:end]
        at = end


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _powers(n: int) -> list[int]:
    """``n`` as a sum of powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    """Documents laid end to end and cut into sequences; holds less than two batches of them."""

    def __init__(self, size: int, width: int, part: int):
        self.size, self.width, self.part, self.seq = size, width, part, 0
        self.ids: list[bytes] = []
        self.docs: list[tuple[int | None, int, int, int]] = []  # doc_id, start, length, doc_tokens
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.width
        self.docs.append((doc_id, 0, n, n))
        self.ids.append(ids)
        self.held += n

    def flush(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """Batches of full sequences off the front; with ``last`` everything that is held."""
        blob, at = b"".join(self.ids), 0
        while self.held >= self.size * BATCH or (last and self.held):
            full = min(BATCH, self.held // self.size)
            lengths = [self.size] * full or _powers(self.held)
            end = at + sum(lengths) * self.width
            yield self._take(lengths, blob[at:end])
            at = end
        self.ids = [blob[at:]]

    def _take(self, lengths: list[int], payload: bytes) -> pa.RecordBatch:
        total = sum(lengths)
        self.held -= total
        stops = np.cumsum(lengths)
        ends = np.cumsum([d[2] for d in self.docs])
        last = int(np.searchsorted(ends, total))  # the document that holds the last id
        own, begins = self.docs[:last + 1], ends[:last + 1] - [d[2] for d in self.docs[:last + 1]]
        marks = np.unique(np.concatenate((begins, stops[:-1])))
        lens = np.diff(np.append(marks, total))
        of = np.searchsorted(ends[:last + 1], marks, "right")
        starts = marks - begins[of] + np.array([d[1] for d in own])[of]
        rest = self.docs[last + 1:]
        name, start, n, tokens = own[-1]
        if over := int(ends[last]) - total:
            rest.insert(0, (name, start + n - over, over, tokens))
        self.docs = rest
        counts = np.concatenate(([0], np.cumsum(np.bincount(np.searchsorted(stops, marks, "right"), minlength=len(lengths)))))
        lists = lambda a: pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(a, pa.int64()))
        bounds = np.concatenate(([0], stops)) * self.width
        first, self.seq = self.seq, self.seq + len(lengths)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(lengths), self.part, np.int32)), pa.array(np.arange(first, self.seq)),
             pa.array([payload[a:b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()), pa.array(np.full(len(lengths), self.width, np.int32)),
             lists([own[k][0] for k in of.tolist()]), lists(starts), lists(lens), lists([own[k][3] for k in of.tolist()])],
            ["part", "seq", "ids", "width", "doc_ids", "starts", "lengths", "doc_tokens"],
        )


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = 2048) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``size`` ids and return the written table.

    A row is a sequence: part, seq (its order), ids (little-endian, ``width`` bytes each), and for each piece in it
    the document, the place and length in that document and the document's number of ids.  All sequences
    are full but at most log2(size) at the end of each part, whose lengths are powers of two.

    A null text is empty and has its end id alone.  Documents of one key, equal ones and those without
    an id are dealt over as many parts as they need.  Other columns are not carried; an empty table gives no sequences.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(MOST_PARTITIONS, max(spark.sparkContext.defaultParallelism, total // PARTITION_BYTES + 1)))
    keyed = rows.select("doc_id", "text", curve_key("text").alias("key"), F.xxhash64("doc_id", "text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange(parts, "key", "tie", "row").sortWithinPartitions("key", "tie", "row").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        tail = np.array([end_id], enc.dtype).tobytes()
        packer = _Packer(size, enc.dtype.itemsize, TaskContext.get().partitionId())
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for at in range(0, len(texts), _ROWS):
                for name, ids in zip(names[at:at + _ROWS].to_pylist(), enc.texts(texts[at:at + _ROWS].to_pylist())):
                    packer.add(name, ids + tail)
                    if packer.held >= size * BATCH:
                        yield from packer.flush()
        yield from packer.flush(last=True)

    schema = "part int, seq long, ids binary, width int, doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>, doc_tokens array<bigint>"
    return cut(ordered.mapInArrow(run, schema), "packed")


def pieces(sequences: DataFrame) -> DataFrame:
    """Read sequences back, a row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The numbers of sequences of parts, at most MOST_PARTITIONS rows, are broadcast.
    """
    sums = sequences.groupBy("part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, seq, ids, width = (batch.column(i) for i in range(4))
            lists = [batch.column(i) for i in range(4, 8)]
            counts = np.diff(lists[0].offsets.to_numpy())
            lengths, offset, sums_ = lists[2].flatten().to_numpy(), np.zeros(int(counts.sum()), np.int64), []
            at = 0
            for blob, w, n in zip(ids, width.to_pylist(), counts.tolist()):
                own = np.frombuffer(blob.as_buffer(), f"<u{w}").astype("<u4")
                stops = np.cumsum(lengths[at:at + n])
                offset[at:at + n] = stops - lengths[at:at + n]
                sums_ += [zlib.crc32(own[a:b]) for a, b in zip(offset[at:at + n], stops)]
                at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.to_numpy(), counts)), pa.array(np.repeat(seq.to_numpy(), counts)), lists[0].flatten(), lists[1].flatten(),
                 lists[2].flatten(), lists[3].flatten(), pa.array(sums_, pa.int64()), pa.array(offset)],
                ["part", "seq", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "offset"],
            )

    rows = sequences.mapInArrow(run, "part int, seq long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, offset long")
    placed = rows.join(F.broadcast(firsts), "part")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("seq")).alias("sequence_id"), "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13(docs: DataFrame) -> DataFrame:
    return pieces(pack(docs, default_tokenizer()))
