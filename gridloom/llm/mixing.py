"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A source table of at most this many rows is broadcast; above it the join is shuffled.
BROADCAST_ROWS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(totals: DataFrame, cycle: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """Add ``weight``: the cycle dealt over sources in code-point order, null last.

    ``totals`` has one row per source; the ordering runs over that small table only.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return totals.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (place - 1) % len(cycle) + 1))


def targets(totals: DataFrame, max_repeat: float = 3.0) -> DataFrame:
    """Share the sum of ``source_size`` by ``weight``, no source above ``max_repeat`` times its size.

    Input columns source, source_size, weight; adds ``target``.  Sources that reach
    their ceiling first (smallest size to weight) form a prefix in that order, so one
    pass of running sums finds the level at which the excess is shared again.
    """
    order = Window.orderBy(F.col("_level"), F.col("source").asc_nulls_last())
    so_far, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = totals.withColumn("_level", F.lit(max_repeat) * F.col("source_size") / F.col("weight"))
    t = t.withColumn("_size_before", F.coalesce(F.sum("source_size").over(so_far), F.lit(0)))
    t = t.withColumn("_weight_before", F.coalesce(F.sum("weight").over(so_far), F.lit(0.0)))
    t = t.withColumn("_size_all", F.sum("source_size").over(whole)).withColumn("_weight_all", F.sum("weight").over(whole))
    rest = F.col("_size_all") - F.lit(max_repeat) * F.col("_size_before")
    t = t.withColumn("_full", rest > F.col("_level") * (F.col("_weight_all") - F.col("_weight_before")))
    t = t.withColumn("_full_size", F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).over(whole))
    t = t.withColumn("_open_weight", F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(whole))
    share = (F.col("_size_all") - F.lit(max_repeat) * F.col("_full_size")) * F.col("weight") / F.col("_open_weight")
    target = F.when(F.col("_full"), F.lit(max_repeat) * F.col("source_size")).otherwise(F.coalesce(share, F.lit(0.0)))
    return t.select("source", "source_size", "weight", target.cast("double").alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) drawn from a hash of seed and key, null as the empty key; the same on every run and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, weigh=cyclic_weights, *, max_repeat: float = 3.0, seed: int = 17) -> DataFrame:
    """Add the mix decision to ``docs``: mix_size, mix_source_size, mix_target, mix_copies.

    Sizes are word counts.  Every source gets ``target`` words: its rate is target over
    size, each document is taken floor(rate) times and once more with probability
    equal to the fraction, by a hash of its doc_id.  ``weigh`` adds ``weight`` to the
    table (source, source_size); that table, a row for each source and not for each document, is ordered in one task.

    Nulls: a null text has size 0, a null source is a source of its own, a null doc_id is
    hashed as the empty key.  Rows that share a doc_id share its draw.  A source of size 0 is
    taken once.  An empty table stays empty.  Other columns pass through.
    """
    sized = docs.withColumn("mix_size", word_count(F.col("text")))
    totals = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    plan = targets(weigh(totals), max_repeat).select(
        F.col("source").alias("_mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
    )
    same = sized["source"].eqNullSafe(plan["_mix_source"])
    n = docs.select("source").distinct().limit(BROADCAST_ROWS + 1).count()
    mixed = sized.join(F.broadcast(plan) if n <= BROADCAST_ROWS else plan, same, "inner")
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(1.0))
    whole = F.floor(rate)
    extra = (uniform(F.col("doc_id"), seed) < rate - whole).cast("long")
    return mixed.withColumn("mix_copies", whole + extra).drop("_mix_source")


def mixed_corpus(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    m = mix(docs.select("doc_id", "source", "text", F.struct("*").alias("_row")), **options)
    return m.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int"))).alias("_copy")).select("_row.*")


def op1(docs: DataFrame) -> DataFrame:
    m = mix(docs.select("doc_id", "source", "text"))
    return m.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighted AS (
  SELECT source, s, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w FROM totals),
levels AS (SELECT *, 3e0 * s / w AS level FROM weighted),
running AS (
  SELECT *, coalesce(sum(s) OVER before, 0) AS s_before, coalesce(sum(w) OVER before, 0) AS w_before,
         sum(s) OVER () AS s_all, sum(w) OVER () AS w_all
  FROM levels WINDOW before AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, (s_all - 3e0 * s_before) > level * (w_all - w_before) AS is_full FROM running),
closed AS (
  SELECT *, sum(CASE WHEN is_full THEN s ELSE 0 END) OVER () AS s_full, sum(CASE WHEN is_full THEN 0e0 ELSE w END) OVER () AS w_open FROM marked),
plan AS (
  SELECT source, s, CAST(CASE WHEN is_full THEN 3e0 * s ELSE coalesce((s_all - 3e0 * s_full) * w / nullif(w_open, 0), 0) END AS DOUBLE) AS target FROM closed),
rated AS (
  SELECT d.doc_id, d.size, p.s, p.target, CASE WHEN p.s > 0 THEN p.target / p.s ELSE 1e0 END AS rate,
         CAST(('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496e0 AS draw
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated
"""
