"""Fill-in-middle transformation over an index of distinct texts.

Rows are grouped by their whole text, so that only equal bytes share a group.  Each group
gets the ends of its units once, as an Elias-Fano list; its documents are laid beside it again and
each takes its own two cuts from the list by select.  Output and inverse are Spark expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from . import bytescan, eliasfano

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Ids that one row of the index holds at least before a text is dealt over several, and the most texts so dealt.
GROUP_IDS, MOST_HOT = 1000, 10_000


@F.arrow_udf(StructType([StructField("n", LongType()), StructField("ends", BinaryType())]))
def unit_ends(texts: pa.Array) -> pa.Array:
    """Number of units of each text and their ends in code points, Elias-Fano coded.

    A unit is a run of non-blanks with the white space before it, or the white space at the end.
    """
    counts, blobs = [], []
    for _, _, data, offsets in bytescan.slices(texts):
        _, ends, first = bytescan.words(data, offsets, "blank")
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        for k in range(len(offsets) - 1):
            own = points[ends[first[k]:first[k + 1]]]
            stop = points[offsets[k + 1]]
            if stop > points[offsets[k]] and (not len(own) or own[-1] < stop):
                own = np.append(own, stop)
            counts.append(len(own))
            blobs.append(eliasfano.encode(own - points[offsets[k]]))
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())], ["n", "ends"])


@F.arrow_udf(StructType([StructField("first", LongType()), StructField("second", LongType())]))
def cuts(ends: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """Code points before unit ``low`` and before unit ``high``, by select; null where no cut is asked for."""
    out = []
    for blob, a, b in zip(ends, low.to_pylist(), high.to_pylist()):
        if a is None:
            out.append((None, None))
            continue
        s = eliasfano.Sequence(blob.as_buffer())
        out.append((s[a - 1] if a else 0, s[b - 1] if b else 0))
    first, second = zip(*out) if out else ((), ())
    return pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["first", "second"])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The index: text, docs array<struct<doc_id>>, units struct<n, ends>.

    A row is a distinct text with the ids of its documents.  A text with more copies than max(GROUP_IDS, a
    ten-thousandth of all rows), which at most MOST_HOT texts can have, is dealt over as many rows as it has
    times that number; everything else about a text is worked out once.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    most = max(GROUP_IDS, docs.count() // MOST_HOT)
    # a hash shared by chance only makes a group be dealt that need not be
    hot = rows.groupBy("key").agg(F.count("*").alias("copies")).where(F.col("copies") > most)
    share = F.ceil(F.col("copies") / most)
    # equal rows are dealt as well: which of them goes where changes nothing
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), share), F.lit(0))
    dealt = rows.join(F.broadcast(hot), "key", "left").withColumn("salt", salt)
    groups = dealt.groupBy("key", "salt", "text").agg(F.collect_list(F.struct("doc_id")).alias("docs"))
    return groups.select("text", "docs", unit_ends("text").alias("units"))


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text) in fill-in-middle form: doc_id, n, form, prefix_chars, middle_chars, output.

    The sha256 of ``<seed>:<doc_id>`` gives four draws: two cuts among the n + 1 places between units,
    whether the text is cut at all (``percent``), and the order of the parts (``spm_percent``).
    Texts that are empty or hold one of the markers stay ``plain``; so does a null text, as an empty one.
    A null doc_id draws as an empty string.  Rows repeated in full come out as often as they went in;
    other columns are not carried; an empty table gives no rows.
    """
    placed = distinct_texts(docs).select("text", "units", F.explode("docs").alias("doc")).select("text", "units", "doc.doc_id")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("_digest", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    plain = (F.col("text") == "") | F.col("text").rlike("<[PSM]>") | (h[2] % 100 >= percent)
    placed = placed.withColumn("_digest", digest).withColumn("n", F.col("units.n"))
    placed = placed.withColumn("form", F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
    low, high = (F.when(F.col("form") != "plain", f(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1))) for f in (F.least, F.greatest))
    cut = placed.withColumn("_cut", cuts("units.ends", low, high))
    first, second = F.col("_cut.first"), F.col("_cut.second")
    part = {
        PREFIX: F.substr("text", F.lit(1), first.cast("int")),
        MIDDLE: F.substr("text", (first + 1).cast("int"), (second - first).cast("int")),
        SUFFIX: F.substr("text", (second + 1).cast("int")),
    }
    psm, spm = (F.concat(*[x for m in order for x in (F.lit(m), part[m])]) for order in ((PREFIX, SUFFIX, MIDDLE), (SUFFIX, PREFIX, MIDDLE)))
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return cut.select("doc_id", "n", "form", first.alias("prefix_chars"), (second - first).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.  Parts of a cut text hold no marker, so each is found where it stands."""
    parts = F.split(output, "<[PSM]>")
    a, b, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(a, middle, b)).otherwise(F.concat(b, middle, a))


def op12(docs: DataFrame) -> DataFrame:
    out = fill_in_middle(docs)
    text = restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    )


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
  CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1:a], '') AS x, array_to_string(w[a + 1:b], '') AS y, array_to_string(w[b + 1:], '') AS z FROM c)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
