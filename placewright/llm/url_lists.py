"""Temporal URL lists (operator 6): DataFrame operations only.

A list is a history of dated entries (``add`` or ``remove`` of a host, a domain or a URL prefix).  The history of an
entry becomes validity intervals [valid_from, valid_to); a capture is evaluated against the entries that were active
when it was fetched.  The as-of join is an equi-join on the keys of a capture (its host, every domain above it, every
part of its path from the root, with and without a slash behind it) with the interval as a further condition, so it never compares captures with unrelated
entries, and a hot host is split by the adaptive skew join.  The most specific active entry decides (prefix before
host before domain, then the longer one), ``allow`` before ``block``.

Defined results: a URL that is null or has no host matches nothing and gets the verdict ``none``, as does a null
fetch date; entries with null fields are left out; of several entries of one day for the same value the ``remove``
counts; repeated captures (equal id, URL and date) are one; empty lists leave every capture at ``none``; ties (one value
blocked and allowed) go to ``allow``; very long URLs have all their keys; prefixes end where a part of a path does, and
an address in brackets is a host with its brackets; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewright.llm.common import materialize, read

#: Rank of the kinds of entry, the most specific first.
KINDS = {"prefix": 3, "host": 2, "domain": 1}
HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))), r"\.$", "")


def keys_of(url: Column) -> Column:
    """Array of (kind, value): the host, the domains at and above it, and what the path begins with, part by part."""
    host, path = host_of(url), F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.split(F.regexp_replace(path, "^/", ""), "/")
    upto = lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"))
    parts = F.transform(F.sequence(F.lit(1), F.size(steps)), upto)
    folders = F.transform(F.slice(parts, F.lit(1), F.size(steps) - 1), lambda p: F.concat(p, F.lit("/")))
    begins = F.concat(F.array(F.concat(host, F.lit("/"))), folders, parts)
    key = lambda kind: lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    found = F.concat(F.array(key("host")(host)), F.transform(domains, key("domain")), F.transform(begins, key("prefix")))
    return F.when(host != "", F.array_distinct(found)).otherwise(F.array().cast("array<struct<kind:string,value:string>>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(verdict, kind, value, valid_from, valid_to) from (verdict, kind, value, action, day); the last end is null."""
    clean = entries.dropna(subset=["verdict", "kind", "value", "action", "day"])
    daily = clean.groupBy("verdict", "kind", "value", "day").agg(F.max(F.col("action") == "remove").alias("gone"))
    history = Window.partitionBy("verdict", "kind", "value").orderBy("day")
    changes = daily.withColumn("__before", F.coalesce(F.lag("gone").over(history), F.lit(True))).filter("gone <> __before")
    return changes.withColumn("valid_to", F.lead("day").over(history)).filter(~F.col("gone")).select("verdict", "kind", "value", F.col("day").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, intervals: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """Per capture: host, number of active entries, verdict, and the entry that decided."""
    keyed = captures.select(F.col(id_col), F.col(url_col), F.col(time_col)).distinct().withColumn("__k", F.explode_outer(keys_of(F.col(url_col))))
    keyed = keyed.select(id_col, url_col, time_col, F.col("__k.kind").alias("kind"), F.col("__k.value").alias("value"))
    at = F.col(time_col)
    active = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    met = keyed.join(intervals, (keyed["kind"] == intervals["kind"]) & (keyed["value"] == intervals["value"]) & active, "left").select(id_col, url_col, time_col, intervals["kind"], intervals["value"], "verdict")
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in KINDS.items()])
    order = F.when(F.col("verdict").isNotNull(), F.struct(rank.alias("rank"), F.length("value").alias("size"), (F.col("verdict") == "allow").alias("allow"), F.col("kind"), F.col("value"), F.col("verdict")))
    best = met.groupBy(id_col, url_col, time_col).agg(F.count("verdict").alias("n_active"), F.max(order).alias("__best"))
    return best.select(id_col, host_of(F.col(url_col)).alias("host"), time_col, "n_active", F.coalesce("__best.verdict", F.lit("none")).alias("verdict"), F.coalesce(F.concat_ws(":", "__best.kind", "__best.value"), F.lit("")).alias("entry"))


def _digits(value: str, begin: int, n: int) -> Column:
    return F.conv(F.substring(F.md5(F.col(value).cast("binary")), begin, n), 16, 10).cast("int")


def synthetic_lists(pages: DataFrame) -> DataFrame:
    """A dated list history over the hosts, domains and top directories that the pages have.

    The tables bring no lists, so each value gets up to three events whose days come from digits of its MD5.
    """
    url = F.col("url")
    keys = pages.select(F.explode(keys_of(url)).alias("k")).select("k.kind", "k.value").distinct()
    keys = keys.filter((F.col("kind") != "domain") | F.col("value").contains("."))
    first, length, again = _digits("value", 1, 3) % 365, _digits("value", 4, 2) % 120, _digits("value", 6, 2) % 90
    keys = keys.withColumn("a", first).withColumn("b", first + 1 + length).withColumn("c", first + 2 + length + again)
    keys = keys.filter(_digits("value", 8, 2) % 4 < 3).withColumn("verdict", F.when(_digits("value", 10, 1) < 3, "allow").otherwise("block"))
    events = F.array(*[F.struct(F.lit(action).alias("action"), F.col(c).alias("n")) for action, c in (("add", "a"), ("remove", "b"), ("add", "c"))])
    return keys.select("verdict", "kind", "value", F.explode(events).alias("e")).select("verdict", "kind", "value", "e.action", F.date_add(F.lit("2024-01-01").cast("date"), F.col("e.n")).alias("day"))


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against the entries active on their fetch days."""
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("page_id") * 37) % 500).cast("int")))
    # written, so that the join reads it anew and a host or a root of very many pages can be split
    intervals = materialize(validity_intervals(synthetic_lists(pages)), "intervals")
    found = evaluate(captures, intervals, "page_id", "url", "fetched")
    return found.select("page_id", "host", F.col("fetched").cast("string").alias("fetched"), "n_active", "verdict", "entry")


QUERIES = {"op6_url_lists": op6_url_lists}
ORACLES = {
    "op6_url_lists": r"""
WITH p AS (
  SELECT DISTINCT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 37) % 500 AS INTEGER) AS DATE) AS fetched,
    regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)', 1)), '\.$', '') AS host,
    regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages
), l AS (
  SELECT *, string_split(host, '.') AS labels, string_split(regexp_replace(path, '^/', ''), '/') AS steps FROM p WHERE host <> ''
), k AS (
  SELECT page_id, url, fetched, 'host' AS kind, host AS value FROM l
  UNION
  SELECT page_id, url, fetched, 'domain', array_to_string(labels[i:], '.') FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS i FROM l)
  UNION
  SELECT page_id, url, fetched, 'prefix', host || '/' FROM l
  UNION
  SELECT page_id, url, fetched, 'prefix', host || '/' || array_to_string(steps[1:i], '/') || '/' FROM (SELECT *, unnest(range(1, len(steps))) AS i FROM l)
  UNION
  SELECT page_id, url, fetched, 'prefix', host || '/' || array_to_string(steps[1:i], '/') FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM l)
), v AS (
  SELECT DISTINCT kind, value FROM k WHERE kind <> 'domain' OR contains(value, '.')
), h AS (
  SELECT *, CAST(('0x' || substr(md5(value), 1, 3)) AS INTEGER) % 365 AS a, CAST(('0x' || substr(md5(value), 4, 2)) AS INTEGER) % 120 AS n,
    CAST(('0x' || substr(md5(value), 6, 2)) AS INTEGER) % 90 AS m, CASE WHEN CAST(('0x' || substr(md5(value), 10, 1)) AS INTEGER) < 3 THEN 'allow' ELSE 'block' END AS verdict
  FROM v WHERE CAST(('0x' || substr(md5(value), 8, 2)) AS INTEGER) % 4 < 3
), i AS (
  SELECT verdict, kind, value, CAST(DATE '2024-01-01' + a AS DATE) AS f, CAST(DATE '2024-01-01' + a + 1 + n AS DATE) AS t FROM h
  UNION ALL
  SELECT verdict, kind, value, CAST(DATE '2024-01-01' + a + 2 + n + m AS DATE), NULL FROM h
), j AS (
  SELECT k.page_id, k.url, k.fetched, i.verdict, i.kind, i.value,
    row_number() OVER (PARTITION BY k.page_id, k.url, k.fetched ORDER BY CASE i.kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC,
      length(i.value) DESC, i.verdict, i.kind DESC, i.value DESC) AS r,
    count(*) OVER (PARTITION BY k.page_id, k.url, k.fetched) AS n_active
  FROM k JOIN i ON k.kind = i.kind AND k.value = i.value AND k.fetched >= i.f AND (i.t IS NULL OR k.fetched < i.t)
)
SELECT p.page_id, p.host, CAST(p.fetched AS VARCHAR) AS fetched, coalesce(j.n_active, 0) AS n_active, coalesce(j.verdict, 'none') AS verdict,
  coalesce(j.kind || ':' || j.value, '') AS entry
FROM p LEFT JOIN j ON j.r = 1 AND p.page_id = j.page_id AND p.url = j.url AND p.fetched = j.fetched"""
}
