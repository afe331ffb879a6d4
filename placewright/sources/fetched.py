"""Fetched pages as results: what a fetch table says of each requested page, whoever fetched it.

``fetched`` holds one row for each address: url, html, final_url, http_status, error and attempts (see
``connectors.FETCHED``; ``pages.decoded`` makes html of its bytes).  Nothing here visits the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewright.functions.text import error_line, squeeze, strip, text
from placewright.functions.urls import domain_of, host_of, title_of, url_in_domains
from placewright.sources.evidence import SCHEMA as EVIDENCE
from placewright.sources.evidence import page_evidence
from placewright.sources.files import unpacked
from placewright.sources.pages import html_links

STAGE = "official_page_address_evidence"
LINKS = "array<struct<text:string,url:string>>"
#: The texts of warnings.
BAD_REQUEST, LEFT, NO_EVIDENCE = "请求 URL 或官方域名无效", "跳转后的最终 URL 不属于已确认的官方域名：", "未发现可靠地址证据"


def page_domains(domains: Column) -> Column:
    """Official domains as bare hosts, each once, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(domains, F.array().cast("array<string>")), domain_of), lambda d: d != "")))


def official_pages(requests: DataFrame, fetched: DataFrame, labels: list[str]) -> DataFrame:
    """Results of requested pages (url, official_domains): status ok, http_error or error, evidence, links, warnings.

    A page counts only if the address asked for and the one it ended at belong to the official domains.
    """
    seen = fetched.select(F.col("url").alias("__url"), "html", "final_url", "http_status", "error", "attempts")
    df = requests.select(text("url").alias("requested_url"), page_domains(F.col("official_domains")).alias("official_domains"))
    df = df.join(seen, F.col("requested_url") == F.col("__url"), "left")
    last = F.coalesce(F.nullif(text("final_url"), F.lit("")), F.col("requested_url"))
    failure = (
        F.when(~url_in_domains("requested_url", F.col("official_domains")), F.lit(BAD_REQUEST))
        .when(F.col("__url").isNull(), F.lit("not fetched"))
        .when(text("error") != "", text("error"))
        .when(~url_in_domains(last, F.col("official_domains")), F.concat(F.lit(LEFT), last))
    )
    df = df.withColumn("failure", failure)
    bad_status = F.coalesce(F.col("http_status") >= 400, F.lit(False))
    df = df.withColumn("page_status", F.when(F.col("failure").isNotNull(), "error").when(bad_status, "http_error").otherwise("ok"))
    read = F.col("page_status") == "ok"
    came = F.col("page_status") != "error"
    page = F.when(read, F.col("html"))
    anchors = html_links(page, last)["links"]
    df = df.withColumns({"final_url": F.when(came, last).otherwise(""), "evidence": page_evidence(page, labels), "anchors": anchors})
    warning = F.when(F.col("failure").isNotNull(), error_line("failure")).when(~read, F.concat(F.lit("页面返回 HTTP "), F.col("http_status").cast("string"))).when(F.size("evidence") == 0, F.lit(NO_EVIDENCE))
    return df.select(
        F.lit(STAGE).alias("stage"),
        "requested_url",
        "final_url",
        F.when(came, F.col("http_status")).alias("http_status"),
        "page_status",
        F.when(came, title_of("html")).otherwise("").alias("title"),
        "official_domains",
        F.when(read, F.col("evidence")).otherwise(F.array().cast(EVIDENCE)).alias("address_evidence"),
        F.when(read, F.transform("anchors", lambda a: F.struct(F.substring(a["title"], 1, 120).alias("text"), a["url"].alias("url")))).otherwise(F.array().cast(LINKS)).alias("links"),
        F.array_compact(F.array(warning)).alias("warnings"),
        F.coalesce("attempts", F.array().cast(dict(fetched.dtypes)["attempts"])).alias("access_attempts"),
    )


def host_methods(fetched: DataFrame) -> DataFrame:
    """(host, method): the direct method that worked last for each host, to be tried first the next time.

    ``fetched`` has fetched_at besides the columns of a fetch table.
    """
    tries = fetched.select(host_of("url").alias("host"), "fetched_at", F.posexplode("attempts").alias("pos", "a"))
    worked = tries.filter(F.col("a.success") & F.col("a.method").isin("urllib", "curl") & (F.col("host") != ""))
    return worked.groupBy("host").agg(F.max_by("a.method", F.struct("fetched_at", "pos")).alias("method"))


def pdf_report(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(file, page, text_character_count, image_count, text_preview, inspection_status, vision_reason) of PDF pages.

    ``pages`` (file, page, text, image_count) comes from whatever reads PDFs, ``verdicts`` from ``files.pdf_verdict``.
    """
    body = squeeze("text")
    rows = pages.select("file", "page", F.length(body).cast("long").alias("text_character_count"), "image_count", F.substring(body, 1, 400).alias("text_preview"))
    status = verdicts.select("file", F.col("status").alias("inspection_status"), F.when(F.col("status") == "needs_vision", "no_native_text").otherwise("").alias("vision_reason"))
    return rows.join(status, "file")


def pdf_tables(tables: DataFrame, report: DataFrame) -> DataFrame:
    """Cells of tables found on PDF pages (file, page, table_index, row_no, cells) in the form of ``files.cells``.

    Tables count on pages with 20 characters or more of files whose own text can be used.
    """
    good = report.filter((F.col("text_character_count") >= 20) & (F.col("inspection_status") != "needs_vision")).select("file", "page", "inspection_status")
    place = F.to_json(F.struct("page", "table_index"))
    place = F.regexp_replace(F.regexp_replace(place, ":", ": "), ",", ", ")
    return tables.join(good, ["file", "page"]).select(
        "file", F.lit("pdf_table").alias("kind"), place.alias("location"), F.col("row_no").cast("int").alias("row_no"), F.transform("cells", squeeze).alias("cells"), F.col("inspection_status").alias("status"), F.lit(None).cast("string").alias("error")
    )


def leaves_folder(path: Column) -> Column:
    """Whether a path leads out of the folder that it is in."""
    step = lambda d, s: F.when(d < 0, d).when(s == "..", d - 1).when(s.isin("", "."), d).otherwise(d + 1)
    depth = F.aggregate(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), F.lit(0), step)
    return path.startswith("/") | (depth < 0)


def downloads(manifest: DataFrame, fetched: DataFrame, allowed_domain: str = "") -> DataFrame:
    """Results of a download manifest (file, url): final_url, http_status, size_bytes, extracted, skipped, error.

    ``fetched`` has the content as it came.  Archives are taken apart beside where they lie; of a file that failed, its
    place, its fetch, its final domain or its archive, only the error is given.
    """
    seen = fetched.select(F.col("url").alias("__url"), "content", "final_url", "http_status", "error")
    items = manifest.select(strip("file").alias("file"), strip("url").alias("url")).join(seen, F.col("url") == F.col("__url"), "left")
    outside = ~url_in_domains("final_url", F.array(domain_of(F.lit(allowed_domain)))) if allowed_domain else F.lit(False)
    error = (
        F.when(leaves_folder(F.col("file")), F.concat(F.lit("输出文件越出目标目录："), F.col("file")))
        .when(F.col("__url").isNull(), F.lit("not fetched"))
        .when(text("error") != "", text("error"))
        .when(outside, F.concat(F.lit("下载结果域名不在允许范围内："), text("final_url")))
    )
    items = items.withColumn("error", error)
    archives = unpacked(items.filter(F.col("error").isNull() & F.lower("file").endswith(".zip")), "file", "content")
    folder = F.regexp_extract("archive", "^(.*/)?[^/]*$", 1)
    members = archives.groupBy("archive").agg(F.array_sort(F.collect_list(F.concat(folder, F.col("path")))).alias("extracted"), F.any_value("skipped").alias("skipped"), F.max("error").alias("__bad"))
    met = items.join(members, F.col("file") == F.col("archive"), "left").withColumn("error", F.coalesce("error", "__bad", F.lit("")))
    good, none = F.col("error") == "", F.array().cast("array<string>")
    return met.select(
        "file",
        "url",
        F.when(good, F.col("final_url")).alias("final_url"),
        F.when(good, F.col("http_status")).alias("http_status"),
        F.when(good, F.octet_length("content").cast("long")).alias("size_bytes"),
        F.when(good, F.coalesce("extracted", none)).otherwise(none).alias("extracted"),
        F.when(good, F.coalesce("skipped", none)).otherwise(none).alias("skipped"),
        "error",
    )
