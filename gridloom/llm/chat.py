"""Chat formatting with Spark expressions only.

A conversation becomes one string.  Each message is

    <|im_start|>role<|im_sep|>text<|im_end|>\n

where adjacent turns of one role share a message, their texts parted by
``<|im_next|>``.  They are merged in the array of turns: the places where the role changes cut the
sorted array into runs, and each run is aggregated to one message with the texts of its turns.  In roles and texts a backslash becomes two and ``<|`` becomes
``<\\|``, so that no text can hold a control string and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, segments array<struct<text, loss>>.

    The segments laid end to end are the formatted conversation; ``loss`` marks those
    that a model is trained on (the texts of assistant turns).  :func:`formatted` joins
    them.

    Null text or role: empty.  Turns sort by turn, null first; ties by role, then text.
    Rows repeated in full stay repeated.  A null conv_id is a conversation of its own.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn"), role.alias("role"), text.alias("text")))).alias("t")
    )
    return rows.select("conv_id", messages(F.col("t")).alias("m")).select("conv_id", _segments(F.col("m")).alias("segments"))


def messages(turns: Column) -> Column:
    """Sorted turns (role, text) to messages: array<struct<role, texts array<string>>>, adjacent turns of one role in one."""
    role = lambda i: F.get(turns, i)["role"]
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    begins = F.filter(places, lambda i: (i == 0) | (role(i) != role(i - 1)))

    def merged(begin: Column, k: Column) -> Column:
        run = F.slice(turns, begin + 1, F.coalesce(F.get(begins, k + 1), F.size(turns)) - begin)
        return F.struct(role(begin).alias("role"), F.transform(run, lambda x: x["text"]).alias("texts"))

    return F.when(F.size(turns) > 0, F.transform(begins, merged))


def _segments(messages: Column) -> Column:
    off = F.lit(False)

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def spoken(m: Column) -> Column:
        own = lambda x, k: F.array(segment(F.when(k > 0, F.lit(NEXT)).otherwise(""), off), segment(escape(x), m["role"] == "assistant"))
        head = segment(F.concat(F.lit(START), escape(m["role"]), F.lit(SEP)), off)
        return F.concat(F.array(head), F.flatten(F.transform(m["texts"], own)), F.array(segment(F.lit(END), off)))

    return F.flatten(F.transform(messages, spoken))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order and with nothing between."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))


def read_loss(turns: Column) -> Column:
    """The text under the loss mask, out of the turns read back from a formatted conversation."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")


def read_turns(text: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    messages = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda m: m.startswith(START))

    def turns(m: Column) -> Column:
        halves = F.split(F.substring(m, len(START) + 1, 2147483647), r"<\|im_sep\|>", 2)
        role = unescape(F.element_at(halves, 1))
        return F.transform(
            F.split(F.element_at(halves, 2), r"<\|im_next\|>"),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(messages, turns))


def op3(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_conversations(rows).select("conv_id", formatted(F.col("segments")).alias("formatted"))
    out = out.withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", read_loss(F.col("turns")))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
seen AS (
  SELECT *, lag(role) OVER w AS pr FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|'))
            + CASE WHEN pr IS NOT NULL AND pr = role THEN 11 ELSE 33 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) END AS chars
  FROM seen)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
