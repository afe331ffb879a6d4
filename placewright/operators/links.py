"""Links of directory pages and linked pages, download manifests, domain reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewright.functions.text import squeeze
from placewright.functions.urls import domain_of, probe, raw_host, url_in_domains
from placewright.sources.pages import html_links


def _once(links: DataFrame) -> DataFrame:
    """The first link of a page to each address."""
    order = Window.partitionBy("page", "url").orderBy("pos")
    return links.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def directory_links(pages: DataFrame, allowed_domain: str = "", link_pattern: str = "") -> DataFrame:
    """(page, page_title, pos, title, url) from pages (page, final_url, html): links under a domain that fit a pattern."""
    found = pages.select("page", html_links(F.col("html"), F.col("final_url")).alias("l")).select("page", F.col("l.title").alias("page_title"), F.explode("l.links").alias("x")).select("page", "page_title", "x.*").filter("url <> ''")
    if allowed_domain:
        found = found.filter(url_in_domains("url", F.array(domain_of(F.lit(allowed_domain)))))
    if link_pattern:
        found = found.filter(F.rlike("url", F.lit(link_pattern)))
    return _once(found)


def link_metrics(manifest: DataFrame, fetched: DataFrame, found: DataFrame) -> DataFrame:
    """page_count, link_count and error_count of a manifest (page), its fetches (page, error) and its links (page, url)."""
    per_page = found.groupBy("page").agg(F.count("*").alias("n"))
    met = manifest.select("page").join(fetched.select("page", F.coalesce("error", F.lit("")).alias("error")), "page", "left").join(per_page, "page", "left")
    return met.agg(F.count("*").alias("page_count"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("link_count"), F.count_if(F.coalesce("error", F.lit("not fetched")) != "").alias("error_count"))


def linked_pages(pages: DataFrame, selector: str, allowed_domain: str = "") -> DataFrame:
    """Links that a selector picks, web addresses of exactly one host, with the file each would be saved as; by address."""
    found = pages.select("page", html_links(F.col("html"), F.lit(""), selector, strict_base=True).alias("l")).select("page", F.explode("l.links").alias("x")).select("page", "x.*")
    found = found.filter(F.rlike("url", F.lit("^(?i:https?)://[^/?#]+")))
    if allowed_domain:
        found = found.filter(raw_host("url") == domain_of(F.lit(allowed_domain)))
    kept = _once(found).withColumn("number", F.row_number().over(Window.partitionBy("page").orderBy("pos")))
    name = F.regexp_extract(F.regexp_extract("url", "^[^:]+://[^/?#]*([^?#]*)", 1), "([^/]+)/*$", 1)
    named = F.when(name == "", F.concat(F.lit("page_"), F.col("number").cast("string"), F.lit(".html"))).otherwise(name)
    return kept.withColumn("file", F.when(F.rlike(F.lower(named), F.lit(r"\.html?$")), named).otherwise(F.concat(named, F.lit(".html")))).drop("number").orderBy("url")


def manifest_error(stage: str, url: str = "url", file: str | None = None) -> Column:
    """What is wrong with a manifest row, or ''."""
    wrong = F.when(F.coalesce(F.col("stage"), F.lit("")) != stage, f"输入必须是 {stage} JSON").when(~F.rlike(squeeze(url), F.lit("^(?i:https?)://[^/?#]+")), "清单网址无效")
    return (wrong.when(squeeze(file) == "", "清单缺少文件名") if file else wrong).otherwise("")


def download_metrics(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Counts of a manifest (file, url) against results (file, final_url, size_bytes, extracted array, error)."""
    met = manifest.select("file").join(results, "file", "left")
    ok = F.col("final_url").isNotNull() & (F.coalesce("error", F.lit("")) == "")
    return met.agg(F.count("*").alias("item_count"), F.count_if(ok).alias("downloaded_count"), F.count_if(ok & (F.size("extracted") > 0)).alias("archive_count"), F.coalesce(F.sum(F.when(ok & F.col("extracted").isNotNull(), F.size("extracted"))), F.lit(0)).alias("extracted_count"), F.count_if(~ok).alias("error_count"))


def probe_domains(items: DataFrame, visits: DataFrame) -> DataFrame:
    """Reports on home pages: items (place_id, place_name, home_url, official_domains), visits (url, final_url, http_status, error, html)."""
    domains = F.array_sort(F.array_distinct(F.transform(F.coalesce("official_domains", F.array().cast("array<string>")), domain_of)))
    seen = visits.select(F.col("url").alias("home_url"), "final_url", "http_status", "error", "html")
    met = items.select(squeeze("place_id").alias("place_id"), squeeze("place_name").alias("place_name"), squeeze("home_url").alias("home_url"), domains.alias("official_domains")).join(seen, "home_url", "left")
    missing = F.when(F.col("final_url").isNull() & F.col("error").isNull(), F.lit("not fetched")).otherwise(F.col("error"))
    report = probe(F.col("home_url"), F.col("final_url"), F.col("http_status"), missing, F.col("html"), F.col("place_name"), F.col("official_domains"))
    invalid = F.when(F.col("place_id") == "", "域名探测记录缺少 place_id").when(F.col("place_name") == "", F.concat("place_id", F.lit(" 域名探测记录缺少 place_name"))).when(F.col("home_url") == "", F.concat("place_id", F.lit(" 域名探测记录缺少 home_url"))).otherwise("")
    return met.withColumn("r", report).select("place_id", "place_name", "home_url", "official_domains", "r.*", invalid.alias("input_error"))
