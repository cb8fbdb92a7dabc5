"""URL filters: a temporal join of captures with dated lists, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: At most so many list intervals are broadcast; above that the join is shuffled, and adaptive execution splits its hot keys.
BROADCAST_KEYS = 200_000


def host(url: Column) -> Column:
    """Host of a URL: lower case, without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":\d*$", "")
    return F.lower(F.regexp_replace(bare, r"\.$", ""))


def keys(url: Column) -> Column:
    """What a list entry may name of a URL: the host with each parent domain, and host and first path part."""
    h = host(url)
    labels = F.split(h, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, n), ".").alias("value")))
    part = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    prefix = F.array(F.struct(F.lit("prefix").alias("kind"), F.concat(h, F.lit("/"), part).alias("value")))
    none = F.slice(prefix, F.lit(1), F.lit(0))
    return F.when(url.isNull() | (h == ""), none).otherwise(F.concat(domains, F.when(part != "", prefix).otherwise(none)))


def intervals(entries: DataFrame) -> DataFrame:
    """Dated entries (list, kind, value, listed, at) to validity intervals (kind, value, list, start, stop).

    An entry holds from its time to the next one of the same list and value; ``stop`` is null
    while there is none.  Of entries of one time a removal is the later one.  Entries
    with a null in list, kind, value, listed or at are left out.
    """
    good = entries.dropna(subset=["list", "kind", "value", "listed", "at"]).select("list", "kind", "value", "listed", "at").distinct()
    order = Window.partitionBy("list", "kind", "value").orderBy("at", F.desc("listed"))
    held = good.withColumn("stop", F.lead("at").over(order)).where("listed")
    return held.where(F.col("stop").isNull() | (F.col("stop") > F.col("at"))).select("kind", "value", "list", F.col("at").alias("start"), "stop")


def match_lists(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Lists that name each capture (url, fetched) at its fetch time: adds lists array<string>, ascending.

    Each distinct (url, fetched) is filed under its keys and meets the intervals of a key that hold at its
    time: an as-of join, equal keys with the interval as a condition.  A null url, a url without host
    and a null fetch time are named by no list.  Rows repeated in full stay repeated.  A column
    named lists is replaced; all others pass through whatever their name or type.
    """
    held = intervals(entries)
    few = held.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    asked = captures.select("url", "fetched").where(F.col("url").isNotNull() & F.col("fetched").isNotNull()).distinct()
    filed = asked.select("url", "fetched", F.explode(keys(F.col("url"))).alias("key")).select("url", "fetched", "key.*")
    now = (F.col("start") <= F.col("fetched")) & (F.col("stop").isNull() | (F.col("stop") > F.col("fetched")))
    met = filed.join(F.broadcast(held) if few else held, ["kind", "value"]).where(now)
    named = met.groupBy("url", "fetched").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    rows = captures.drop("lists").select("url", "fetched", F.struct("*").alias("row"))
    out = rows.join(named, ["url", "fetched"], "left")
    return out.select("row.*", F.coalesce("lists", F.array().cast("array<string>")).alias("lists"))


def sample_lists(pages: DataFrame) -> DataFrame:
    """Dated entries over the hosts of ``pages``, by a hash of the host: the tables hold no lists of their own."""
    h = pages.select(host(F.col("url")).alias("host")).where(F.col("host") != "").distinct()
    k = F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 6), 16, 10).cast("int")
    h = h.withColumn("k", k).withColumn("parent", F.regexp_replace("host", r"^[^.]*\.", ""))
    day = lambda d: F.date_add(F.lit("2024-01-01").cast("date"), d)

    def entry(cond: Column, name: str, kind: str, value: Column, listed: bool, at: Column) -> DataFrame:
        return h.where(cond).select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), value.alias("value"), F.lit(listed).alias("listed"), at.alias("at"))

    k, own = F.col("k"), F.col("host")
    out = entry(k % 4 == 0, "ads", "domain", own, True, day(k % 200))
    out = out.unionByName(entry(k % 4 == 0, "ads", "domain", own, False, day(k % 200 + 60)))
    out = out.unionByName(entry((k % 4 == 0) & (k % 3 == 0), "ads", "domain", own, True, day(k % 200 + 120)))
    out = out.unionByName(entry(k % 5 == 0, "adult", "domain", F.col("parent"), True, day(F.lit(50))))
    return out.unionByName(entry(k % 7 == 0, "spam", "prefix", F.concat(own, F.lit("/en")), True, day(k % 300)))


def op2(pages: DataFrame) -> DataFrame:
    """All pages, taken as fetched on day page_id modulo 366 of 2024, against :func:`sample_lists`."""
    p = pages.select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), F.coalesce(F.col("page_id") % 366, F.lit(0)).cast("int"))
    out = match_lists(p.withColumn("fetched", fetched), sample_lists(p))
    return out.select("page_id", "url", host(F.col("url")).alias("host"), F.array_join("lists", ",").alias("lists"), (F.size("lists") > 0).alias("blocked"))


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(coalesce(page_id % 366, 0) AS INT) AS fetched,
         lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.$', '')) AS host,
         regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS part FROM pages),
h AS (SELECT host, CAST(('0x' || substr(md5(host), 1, 6)) AS INT) AS k, regexp_replace(host, '^[^.]*\.', '') AS parent FROM (SELECT DISTINCT host FROM p WHERE host <> '')),
e AS (
  SELECT 'ads' AS list, 'domain' AS kind, host AS value, true AS listed, DATE '2024-01-01' + k % 200 AS at_ FROM h WHERE k % 4 = 0
  UNION SELECT 'ads', 'domain', host, false, DATE '2024-01-01' + (k % 200 + 60) FROM h WHERE k % 4 = 0
  UNION SELECT 'ads', 'domain', host, true, DATE '2024-01-01' + (k % 200 + 120) FROM h WHERE k % 4 = 0 AND k % 3 = 0
  UNION SELECT 'adult', 'domain', parent, true, DATE '2024-01-01' + 50 FROM h WHERE k % 5 = 0
  UNION SELECT 'spam', 'prefix', host || '/en', true, DATE '2024-01-01' + k % 300 FROM h WHERE k % 7 = 0),
i AS (SELECT *, lead(at_) OVER (PARTITION BY list, kind, value ORDER BY at_, listed DESC) AS stop FROM e),
m AS (
  SELECT DISTINCT page_id, url, list FROM p JOIN i ON i.listed AND at_ <= fetched AND (stop IS NULL OR stop > fetched)
   AND ((kind = 'domain' AND (host = value OR ends_with(host, '.' || value))) OR (kind = 'prefix' AND value = host || '/' || part)) WHERE host <> ''),
n AS (SELECT page_id, url, string_agg(list, ',' ORDER BY list) AS lists FROM m GROUP BY 1, 2)
SELECT p.page_id, p.url, host, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked
FROM p LEFT JOIN n ON n.page_id IS NOT DISTINCT FROM p.page_id AND n.url IS NOT DISTINCT FROM p.url
"""
