"""Language identification with bit-sliced Bloom filters of byte n-grams.

For every table position 64-bit words hold a bit per language.  Looking an n-gram up
takes the bitwise AND of a few positions and gives at once the set of languages that
hold it.  Per text and language the hits are counted, the share expected from false
positives is taken off, and the largest count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytescan import mix64, slices
from .scratch import cut

#: Training takes about this many labelled rows, chosen by a hash of doc_id.
SAMPLE_ROWS = 40_000
#: Of each language about so many at least, or all that it has.
LANGUAGE_ROWS = 1000
#: An n-gram belongs to a language if its frequency there is at least this part of its highest in any.
SHARE = 0.5
#: Seen less often in the sample, an n-gram is noise.
LEAST_COUNT = 3
#: Filters have a power of two places, this at least and eight for each n-gram of the largest language.
TABLE_BITS, HASHES = 20, 3

_SPACE = np.arange(256, dtype=np.uint8)
_SPACE[:128] = 32
for _a, _b in ((65, 90), (97, 122)):
    _SPACE[_a:_b + 1] = np.arange(_a, _b + 1)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All 4-byte n-grams as integers with the index of their text; ASCII other than letters
    is a space, and no n-gram holds two spaces in a row."""
    b = _SPACE[data].astype(np.uint32)
    n = len(b) - 3
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    g = b[:n] | b[1:n + 1] << np.uint32(8) | b[2:n + 2] << np.uint32(16) | b[3:] << np.uint32(24)
    double = (b[1:] == 32) & (b[:-1] == 32)
    good = ~(double[:n] | double[1:n + 1] | double[2:n + 2])
    for edge in range(1, 4):
        at = offsets[1:-1] - edge
        good[at[(at >= 0) & (at < n)]] = False
    place = np.flatnonzero(good)
    return g[place], np.searchsorted(offsets, place, "right") - 1


def positions(g: np.ndarray, bits: int) -> list[np.ndarray]:
    """The positions of n-grams in tables of 2**bits places (31 bits at most), one array for each hash."""
    h = mix64(g.astype(np.uint64) + np.uint64(0x5BF03635))
    at = []
    for _ in range(HASHES):
        at.append((h >> np.uint64(64 - bits)).astype(np.int64))
        h = h * np.uint64(0x9E3779B97F4A7C15) ^ (h >> np.uint64(29))
    return at


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    #: for each 64 languages HASHES x 2**bits words of language bits
    tables: list[np.ndarray]
    false_rate: np.ndarray
    bits: int = TABLE_BITS

    @classmethod
    def build(cls, langs: list[str], prior: np.ndarray, members: list[np.ndarray]) -> Model:
        tables = []
        rate = np.ones(len(langs))
        bits = min(31, max(TABLE_BITS, (8 * max(map(len, members)) - 1).bit_length()))
        for word in range(0, len(langs), 64):
            part = members[word:word + 64]
            width = np.min_scalar_type((1 << len(part)) - 1)
            table = np.zeros((HASHES, 1 << bits), width)
            for bit, g in enumerate(part):
                for k, at in enumerate(positions(g, bits)):
                    table[k, at] |= width.type(1 << bit)
                for k in range(HASHES):
                    rate[word + bit] *= np.count_nonzero(table[k] >> width.type(bit) & width.type(1)) / table.shape[1]
            tables.append(table)
        return cls(langs, prior, tables, rate, bits)

    def predict(self, g: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its score for n texts."""
        at = positions(g, self.bits)
        total = np.bincount(text, minlength=n).astype(float)
        counts = np.empty((len(self.langs), n))
        for i in range(len(self.langs)):
            bit = i % 64
            if bit == 0:
                table = self.tables[i // 64]
                masks = table[0][at[0]]
                for k in range(1, HASHES):
                    masks &= table[k][at[k]]
            seen = np.bincount(text, weights=(masks >> masks.dtype.type(bit)) & masks.dtype.type(1), minlength=n)
            counts[i] = np.maximum(0, (seen - total * self.false_rate[i]) / (1 - self.false_rate[i]))
        # texts without evidence fall to the commonest language
        weighed = counts + 1e-6 * self.prior[:, None]
        best = weighed.argmax(axis=0)
        return best, weighed[best, np.arange(n)] / weighed.sum(axis=0)


def _lowered(text: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on labelled rows (doc_id, text, lang); None if there are none.

    The languages are all that occur in ``labelled``; their names and sizes come to the driver.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs, n = sorted(sizes), sum(sizes.values())
    rates = {x: min(1.0, max(sample_rows / n, LANGUAGE_ROWS / sizes[x])) for x in langs}
    least = labelled.sparkSession.createDataFrame([(x, int(1_000_000 * r)) for x, r in rates.items()], "lang string, _least long")
    keep = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1_000_000)) < F.col("_least")
    sample = labelled.join(F.broadcast(least), "lang").where(keep).select(_lowered(F.col("text")).alias("text"), "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(langs)}
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.uint64)
            for a, b, data, offsets in slices(batch.column(0)):
                g, text = grams(data, offsets)
                key, times = np.unique(lang[a:b][text] << np.uint64(32) | g, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(times.astype(np.int64))], ["key", "n"])

    counted = sample.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counted = cut(counted.select(F.shiftright("key", 32).cast("int").alias("lang"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("gram"), "n"), "grams")
    mass = counted.groupBy("lang").agg(F.sum("n").alias("s"))
    rated = counted.join(F.broadcast(mass), "lang").select("lang", "gram", "n", (F.col("n") / F.col("s")).alias("f"))
    # One row per n-gram with its language entries: at most one for each language.
    best = rated.groupBy("gram").agg(F.max("f").alias("top"), F.collect_list(F.struct("lang", "n", "f")).alias("by"))
    told = best.select("gram", "top", F.explode("by").alias("x")).where((F.col("x.f") >= SHARE * F.col("top")) & (F.col("x.n") >= LEAST_COUNT))
    # as many as the bounded sample has; 12 bytes each
    kept = told.select("x.lang", "gram").toArrow()
    lang, gram = kept["lang"].to_numpy(), kept["gram"].to_numpy().astype(np.uint32)
    order = np.argsort(lang, kind="stable")
    members = np.split(gram[order], np.searchsorted(lang[order], np.arange(1, len(langs))))
    return Model.build(langs, np.array([sizes[x] / n for x in langs]), members)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add lang_pred and lang_score to ``docs``, from column text alone.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.  Of languages
    with equal counts the one more frequent in training is taken, then the first by name; so a text
    without any known n-gram falls to the most frequent language.  Columns of those two names are
    replaced; all others pass through whatever their name.
    """
    docs = docs.drop("lang_pred", "lang_score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "lang_score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        m: Model = shared.value
        best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b, data, offsets in slices(texts):
            i, s = m.predict(*grams(data, offsets), b - a)
            best.append(i)
            score.append(s)
        names = pa.array(m.langs).take(pa.array(np.concatenate(best)))
        return pa.StructArray.from_arrays([names, pa.array(np.concatenate(score))], ["lang", "score"])

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    scored = docs.select(F.struct("*").alias("row"), predict(_lowered(F.col("text"))).alias("told"), has_letter.alias("letter"))
    pred = F.when(F.col("letter"), F.col("told.lang")).otherwise("und")
    score = F.when(F.col("letter"), F.col("told.score")).otherwise(0.0)
    return scored.select("row.*", pred.alias("lang_pred"), score.alias("lang_score"))


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` in which a language was found; the others are rejected."""
    rows = docs.select("text", F.struct("*").alias("_row"))
    return identify(rows, model).where(F.col("lang_pred") != "und").select("_row.*")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> Model | None:
    """The model fitted on the rows of ``docs`` outside the held-out fold."""
    return train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def op10(docs: DataFrame) -> DataFrame:
    model = learned(docs)
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
