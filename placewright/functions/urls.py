"""URL, domain, title and source-reference columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placewright.functions.text import WS, squeeze, strip, text, without_space

HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\[]*)"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
CHARSET = r"(?i)charset\s*=\s*[\"']?\s*([\w-]+)"
#: Fixed texts of the domain report.
UNREACHABLE = "主页访问失败，需人工复核域名或按失败项处理"


def raw_host(url: Column | str) -> Column:
    """Lower-case host, '' if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(text(url), HOST, 1)), r"^\[|\]$", "")


def host_of(url: Column | str) -> Column:
    """Lower-case host without final dots."""
    return F.regexp_replace(raw_host(url), r"\.+$", "")


def domain_of(value: Column | str) -> Column:
    """A domain entry, given as a name or a URL, as a bare host."""
    bare = F.regexp_replace(F.lower(strip(value)), r"\.+$", "")
    return F.when(F.contains(bare, F.lit("://")), host_of(bare)).otherwise(bare)


def in_domains(host: Column, domains: Column) -> Column:
    """Whether a host is one of the domains or under one."""
    bare = F.regexp_replace(F.lower(text(host)), r"\.+$", "")
    return F.exists(domains, lambda d: (d != "") & ((bare == d) | F.endswith(bare, F.concat(F.lit("."), d))))


def url_in_domains(url: Column | str, domains: Column) -> Column:
    """Whether a web address belongs to one of the domains."""
    host = host_of(url)
    return F.rlike(text(url), F.lit(r"^(?i:https?)://")) & (host != "") & in_domains(host, domains)


def title_of(html: Column | str) -> Column:
    """Text of the first title element, entities as they are."""
    return squeeze(F.regexp_extract(text(html), TITLE, 1))


def title_names(title: Column, name: Column) -> Column:
    """Whether a title holds a name, or the name without what is in brackets."""
    whole = strip(name)
    core = strip(F.regexp_replace(whole, r"[（(][^（）()]*[）)]", ""))
    have = without_space(title)
    return ((whole != "") & F.contains(have, without_space(whole))) | ((core != "") & (core != whole) & F.contains(have, without_space(core)))


def charset_of(content_type: Column | str) -> Column:
    return F.regexp_extract(text(content_type), CHARSET, 1)


def source_url(reference: Column | str) -> Column:
    """The address that a source reference starts with."""
    return F.regexp_extract(strip(reference), f"^((?i:https?)://[^|{WS[1:-1]}]+)", 1)


def source_reference(reference: Column | str) -> Column:
    """Address, file and row of a source reference."""
    parts = F.filter(F.transform(F.split(text(reference), r"\|"), strip), lambda x: x != "")
    row = F.filter(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), lambda x: F.rlike(x, F.lit(rf"^(?i:row){WS}+\p{{Nd}}+$")))
    found = F.array(source_url(reference), F.coalesce(F.get(parts, F.lit(1)), F.lit("")), F.coalesce(F.get(row, F.lit(0)), F.lit("")))
    return F.array_join(F.filter(found, lambda x: x != ""), " | ")


def located(url: Column, parts: list[Column]) -> Column:
    """A source reference from the address of a source and the place in it."""
    return F.array_join(F.filter(F.array(text(url), *parts), lambda x: x != ""), " | ")


def probe(home_url: Column, final_url: Column, status: Column, error: Column, html: Column, name: Column, domains: Column) -> Column:
    """The report on one visited home page, as a struct."""
    failed = error.isNotNull() & (error != "")
    last = F.when(failed, "").otherwise(F.coalesce(F.nullif(text(final_url), F.lit("")), home_url))
    host = host_of(last)
    moved = (host != "") & (host != host_of(home_url))
    listed = in_domains(host, domains)
    title = F.when(failed, "").otherwise(title_of(html))
    known = ~failed & title_names(title, name)
    advice = (
        F.when(failed, F.lit(UNREACHABLE))
        .when(moved & ~listed & known, F.concat(F.lit("主页跳转至白名单外的 "), host, F.lit(" 且页面身份匹配：建议将 "), host, F.lit(" 并入 official_domains，并把主页改为 "), last))
        .when(moved & ~listed, F.concat(F.lit("主页跳转至白名单外的 "), host, F.lit("，但终页标题不含机构名称，需人工复核后决定")))
        .when(moved, F.concat(F.lit("主页跳转至白名单内的 "), host, F.lit("，可将主页改为 "), last, F.lit(" 减少跳转")))
        .otherwise("")
    )
    return F.struct(
        (~failed).alias("reachable"), F.when(~failed, status).alias("http_status"), last.alias("final_url"), host.alias("final_domain"), (~failed & moved).alias("redirected"),
        (~failed & listed).alias("final_domain_in_whitelist"), F.substring(title, 1, 200).alias("title"), known.alias("identity_match"), F.when(failed, F.substring(error, 1, 300)).otherwise("").alias("error"), advice.alias("suggestion"),
    )
