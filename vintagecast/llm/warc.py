"""WARC records and not-modified revisits.

``parse`` reads WARC records from bytes.  ``resolve`` gives every revisit the
latest full response of the same canonical address before it (an as-of join),
checks that it is the one the server meant, and merges the headers:

* address: scheme, ``www``, default port, fragment, tracking parameters and a
  trailing slash don't count, parameters count in any order;
* validators: entity tags by weak comparison if both records have one, else
  Last-Modified; a payload digest on the revisit must be the response's;
* headers: a field of the 304 takes the place of all stored fields of its name,
  except those that belong to one message or describe its own body.

The as-of join never gathers an address: within (address, hour) a running
maximum, between hours one row for each.

Defined cases: records without an address, a date or an id take no part as
responses and stay unresolved as revisits; of responses with the same date the
one with the larger id counts; a response of the revisit's own date isn't
earlier; repeated rows are resolved each; an empty table gives an empty
result; other columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Fixed values (HTTP): fields of a 304 that don't replace stored ones.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
#: Query parameters that don't choose a page.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|msclkid|yclid|mc_[ce]id|phpsessid|jsessionid|sid|sessionid|aspsessionid[a-z]*)"
NOT_MODIFIED = "server-not-modified"
HOUR = 3600

RECORD = (
    "record_id string, kind string, uri string, date string, profile string, payload_digest string, status int, "
    "headers array<struct<name:string,value:string>>, payload binary"
)


def _fields(block: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in block.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:  # a folded line
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def records(data: bytes) -> Iterator[tuple]:
    """Responses and revisits of a WARC file's bytes, in order; raises
    ValueError where a record doesn't fit its length."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if data[at : at + 5] != b"WARC/" or end < 0:
            raise ValueError(f"no record at {at}")
        head = {k.lower(): v for k, v in _fields(data[at:end])}
        start, length = end + 4, int(head.get("content-length", "0"))
        block = data[start : start + length]
        if len(block) < length or data[start + length : start + length + 4] != b"\r\n\r\n":
            raise ValueError(f"record cut off at {at}")
        at = start + length + 4
        kind = head.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        top, _, body = block.partition(b"\r\n\r\n")
        line, _, rest = top.partition(b"\r\n")
        code = re.match(rb"HTTP/\S+\s+(\d{3})", line)
        digest = head.get("warc-payload-digest") or ("sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode() if kind == "response" else None)
        profile = head.get("warc-profile", "").rstrip("/").rsplit("/", 1)[-1] or None
        headers = [{"name": k, "value": v} for k, v in _fields(rest)]
        yield head.get("warc-record-id", "").strip("<>") or None, kind, head.get("warc-target-uri", "").strip("<>") or None, head.get("warc-date"), profile, digest, int(code[1]) if code else None, headers, body if kind == "response" else b""


def _parse(with_payload: bool):
    pair = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))

    def parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for data in b.column(0) if data.as_py() for r in records(data.as_py())]
            cols = list(zip(*rows)) or [[]] * 9
            kinds = [*[pa.string()] * 6, pa.int32(), pair]
            out = [pa.array(c, t) for c, t in zip(cols, kinds)]
            sizes = pa.array([len(x) for x in cols[8]], pa.int64())
            last = [pa.array(cols[8], pa.binary())] if with_payload else []
            yield pa.RecordBatch.from_arrays([*out, sizes, *last], names=["record_id", "kind", "uri", "date", "profile", "payload_digest", "status", "headers", "payload_bytes"] + ["payload"] * with_payload)

    return parse_all


def parse(files: DataFrame, content: str = "content", with_payload: bool = False) -> DataFrame:
    """Records of WARC bytes (a column of ``files``), one row each; payloads only if asked for."""
    schema = "record_id string, kind string, uri string, date string, profile string, payload_digest string, status int, headers array<struct<name:string,value:string>>, payload_bytes long"
    return files.select(F.col(content).cast("binary").alias("content")).mapInArrow(_parse(with_payload), schema + ", payload binary" * with_payload)


def canonical(uri: Column) -> Column:
    """The address without what doesn't choose a page."""
    bare = F.regexp_replace(F.trim(uri), r"#.*$", "")
    split = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?@]*@)?(?:www\d*\.)?([^/?:]*)(?::(\d+))?([^?]*)(?:\?(.*))?$"
    part = lambda i: F.regexp_extract(bare, "(?is)" + split, i)
    scheme, host, port, path, query = F.lower(part(1)), F.lower(part(2)), part(3), part(4), part(5)
    usual = (port == "") | (scheme == "http") & (port == "80") | (scheme == "https") & (port == "443")
    args = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.lower(x).rlike(rf"^{TRACKING}(=|$)")))
    path = F.regexp_replace(F.regexp_replace(path, r";jsessionid=[^?/]*", ""), r"/+$", "")
    name = F.concat(host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path), F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(""))
    return F.when(host == "", bare).otherwise(name)


def field(headers: Column, name: str) -> Column:
    """The last value of a header field, null if there is none."""
    return F.try_element_at(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(-1))["value"]


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def merged(stored: Column, fresh: Column) -> Column:
    """Headers of the stored response as the 304 updates them."""
    taken = F.filter(fresh, lambda h: ~F.lower(h["name"]).isin(NOT_MERGED))
    names = F.transform(taken, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), taken)


def resolve(rows: DataFrame) -> DataFrame:
    """Per revisit: record_id, url (canonical), date, outcome, original_id,
    original_date, payload_digest, payload_bytes and headers (merged).  outcome:
    ``resolved``, ``resolved by date only`` (no validator on either side),
    ``no earlier response`` or ``validator differs``; only resolved ones have
    the columns of the original."""
    rows = rows.select(
        "record_id", "kind", canonical(F.col("uri")).alias("url"), F.to_timestamp("date").alias("date"), "payload_digest", "payload_bytes", "headers",
        F.coalesce(F.col("status"), F.lit(0)).alias("status"), F.col("profile"),
    )
    rows = staged(rows.withColumn("ts", F.unix_micros("date")).withColumn("hour", F.floor(F.col("ts") / (HOUR * 1_000_000))), "records")
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull() & F.col("url").isNotNull() & F.col("ts").isNotNull()
    asks = (F.col("kind") == "revisit") & (F.coalesce(F.col("profile"), F.lit(NOT_MODIFIED)) == NOT_MODIFIED)
    revisits, responses = rows.where(asks), rows.where(full)
    key = F.struct("ts", "record_id")

    # narrow rows: the latest response before each revisit, within its hour or from the last hour that has one
    events = responses.select("url", "hour", "ts", key.alias("r")).unionByName(
        revisits.where("url IS NOT NULL AND ts IS NOT NULL").select("url", "hour", "ts").distinct().withColumn("r", F.lit(None).cast("struct<ts:bigint,record_id:string>"))
    )
    within = Window.partitionBy("url", "hour").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = events.withColumn("near", F.max("r").over(within)).where("r IS NULL").select("url", "hour", "ts", "near")
    before = Window.partitionBy("url").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = events.groupBy("url", "hour").agg(F.max("r").alias("r")).withColumn("far", F.max("r").over(before)).select("url", "hour", "far")
    found = inside.join(hours, ["url", "hour"]).select("url", "ts", F.coalesce("near", "far").alias("o")).where("o IS NOT NULL")
    found = found.select("url", "ts", F.col("o.record_id").alias("original_id"), F.col("o.ts").alias("_ts"))
    revisits = revisits.join(found, ["url", "ts"], "left")
    stored = responses.groupBy(F.col("url").alias("_url"), F.col("ts").alias("_at"), F.col("record_id").alias("_id")).agg(
        F.min_by(F.struct("date", "payload_digest", "payload_bytes", "headers"), F.coalesce("payload_digest", F.lit(""))).alias("s")
    )
    same = (F.col("url") == F.col("_url")) & (F.col("_ts") == F.col("_at")) & (F.col("original_id") == F.col("_id"))
    both = revisits.join(stored, same, "left")

    mine, its = F.col("headers"), F.col("s.headers")
    etag, its_etag = _weak(field(mine, "etag")), _weak(field(its, "etag"))
    changed, its_changed = field(mine, "last-modified"), field(its, "last-modified")
    by_tag, by_date = etag.isNotNull() & its_etag.isNotNull(), changed.isNotNull() & its_changed.isNotNull()
    digest = F.col("payload_digest")
    differs = F.when(by_tag, etag != its_etag).when(by_date, changed != its_changed).otherwise(False) | F.coalesce(digest != F.col("s.payload_digest"), F.lit(False))
    outcome = (
        F.when(F.col("s").isNull(), "no earlier response").when(differs, "validator differs")
        .when(by_tag | by_date | digest.isNotNull(), "resolved").otherwise("resolved by date only")
    )
    both = both.withColumn("outcome", outcome)
    good = F.col("outcome").startswith("resolved")
    return both.select(
        "record_id", "url", "date", "outcome", F.when(good, F.col("original_id")).alias("original_id"), F.when(good, F.col("s.date")).alias("original_date"),
        F.when(good, F.col("s.payload_digest")).alias("payload_digest"), F.when(good, F.col("s.payload_bytes")).alias("payload_bytes"), F.when(good, merged(its, mine)).alias("headers"),
    )


def with_payloads(resolved: DataFrame, parsed: DataFrame) -> DataFrame:
    """Resolved revisits with their original's payload (``parsed`` with payloads)."""
    payloads = parsed.where("kind = 'response'").select(F.col("record_id").alias("original_id"), "payload").dropDuplicates(["original_id"])
    return resolved.join(payloads, "original_id", "left")
