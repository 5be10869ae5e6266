"""WARC bytes derived from the pages table: a crawl that takes every page once
and asks again for many of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DAY = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def _record(kind: str, page: Column, n: int, uri: Column, at: Column, block: Column, more: str = "") -> Column:
    head = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"), page, F.lit(f":{n}>\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Date: "), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(f"\r\n{more}Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, block, F.lit("\r\n\r\n"))


def crawl(pages: DataFrame) -> DataFrame:
    """(content): per page the response and up to three revisits.  Every second
    page is asked for again under another spelling of its address and is
    unchanged; every fifth has another entity tag by then; every eleventh was
    asked for before its response."""
    p, url, body = F.col("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit(""))
    at = F.timestamp_seconds(F.lit(1_704_067_200) + p * 7919 % 864_000)
    later = lambda days, hours=F.lit(0): F.timestamp_seconds(F.unix_seconds(at) + days * 86_400 + hours * 3_600)
    tag = F.concat(F.lit('"'), F.substring(F.md5(body), 1, 16), F.lit('"'))
    other = F.when(p % 4 == 0, F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit("utm_medium=crawl"))).otherwise(F.concat(F.regexp_replace(url, "#.*$", ""), F.lit("#again")))
    profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified\r\n"
    day = lambda x: F.date_format(x, _DAY)
    response = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\nDate: "), day(at),
        F.lit("\r\nETag: "), tag, F.lit("\r\nLast-Modified: "), day(later(-30)), F.lit("\r\nCache-Control: max-age=60\r\nX-Served-By: a\r\n\r\n"), body,
    )
    same = lambda when, etag: F.concat(
        F.lit("HTTP/1.1 304 Not Modified\r\nDate: "), day(when), F.lit("\r\nETag: "), etag, F.lit("\r\nCache-Control: max-age=600\r\nContent-Length: 0\r\nConnection: close\r\n\r\n")
    )
    again, third, early = later(1, p % 50), later(90), later(-20)
    page = p.cast("string")
    rows = F.concat(
        _record("response", page, 0, url, at, response),
        F.when(p % 2 == 0, _record("revisit", page, 1, other, again, same(again, F.concat(F.lit("W/"), tag)), profile)).otherwise(""),
        F.when(p % 5 == 0, _record("revisit", page, 2, url, third, same(third, F.lit('"changed"')), profile)).otherwise(""),
        F.when(p % 11 == 0, _record("revisit", page, 3, url, early, same(early, tag), profile)).otherwise(""),
    )
    return pages.where(p.isNotNull() & url.isNotNull()).select(rows.alias("content"))
