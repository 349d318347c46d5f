"""WARC records: reading, writing, and resolving not-modified revisits.

A revisit of the server-not-modified profile has headers but no body. It is resolved by an as-of join: the latest full
response of the same canonical URL that is earlier than it, if the validators agree, lends its body and headers, and
the headers that a 304 response may bring anew are taken from the revisit.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Headers that a 304 response carries to update the stored ones (RFC 9110, 15.4.5, and Age, Last-Modified); fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "age", "last-modified")
#: Query parameters that only track where a visitor came from (fixed values).
TRACKING = "utm_[a-z]+|fbclid|gclid"
SLICES = 1024
_END = "\r\n\r\n"


def canonical_url(url: Column) -> Column:
    """The URL without scheme, user, www in front of a host of two or more labels, default port, fragment, tracking parameters, index page and final slash; host in lower case."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?", "")
    host, rest = F.lower(F.regexp_extract(u, "^[^/?]*", 0)), F.regexp_replace(u, "^[^/?]*", "")
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www\\.(?=[^.]+\\.)", "")
    rest = F.regexp_replace(rest, f"([?&])((?:{TRACKING})=[^&]*(&|$))+", "$1")
    rest = F.regexp_replace(rest, "[?&]$", "")
    rest = F.regexp_replace(rest, "/(index\\.html?)?(\\?|$)", "$2")
    return F.concat(host, rest)


def weak(etag: Column) -> Column:
    """An entity tag for the weak comparison that conditional requests use."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """Revisits with what they stand for.

    ``records`` has record_id, url, ts (long), type (``response`` or ``revisit``), status (int), headers (map of
    lower-case names to values) and body, or instead of it any columns that stand for it (they are passed on; the body
    may be a reference). A full response has type ``response``, status 200 and a URL. Returned is a row for each
    revisit: record_id, canonical_url, ts, state, refers_to (the response's record_id), headers (merged) and the
    response's body columns. State is ``resolved``; ``mismatch`` if the entity tags differ, or without tags on both
    sides the dates of last change do; ``unverified`` if no validator is on both sides; or ``missing`` if there is no
    earlier full response. Only resolved rows carry headers and body of the response; others keep the revisit's headers.

    Earlier means a smaller ts; of full responses at one ts that of the largest record_id counts. Rows with a null URL
    or ts are missing. Repeated rows come back as often. Body columns may have any names, but those named canonical_url,
    state or refers_to give way to the result's. Each URL's records are cut into ``slices`` of time, so that one
    URL with a third of all records is spread over as many tasks: a slice hands its last full response to the later ones.
    """
    fixed = {"record_id", "url", "ts", "type", "status", "headers"}
    body = [c for c in records.columns if c.lower() not in fixed | {"canonical_url", "state", "refers_to"}]
    rest = F.struct(*[F.col(f"`{c}`") for c in body]) if body else F.lit(None).cast("int")
    rows = records.select("record_id", "url", "ts", "type", "status", canonical_url(F.col("url")).alias("canonical_url"), F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), rest.alias("rest"))
    low, high = records.agg(F.min("ts"), F.max("ts")).first()
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) // slices))
    rows = rows.withColumn("__slice", F.floor((F.col("ts") - F.lit(low)) / F.lit(width)).cast("int"))
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    # maps have no order: what is compared comes first, and the headers travel as entries
    held = F.when(full, F.struct("ts", "record_id", F.sort_array(F.map_entries("headers")).alias("entries"), "rest"))
    rows = rows.withColumn("__full", held)
    inside = Window.partitionBy("canonical_url", "__slice").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("canonical_url").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.filter(full).groupBy("canonical_url", "__slice").agg(F.max("__full").alias("last"))
    spans = rows.filter("type = 'revisit'").select("canonical_url", "__slice").distinct().join(carried, ["canonical_url", "__slice"], "full")
    carried = spans.withColumn("carried", F.max("last").over(before)).select("canonical_url", "__slice", "carried")
    near = rows.withColumn("near", F.max("__full").over(inside)).filter("type = 'revisit'").drop("__full")
    found = near.join(carried, ["canonical_url", "__slice"], "left").withColumn("found", F.coalesce("near", "carried"))
    stored = F.map_from_entries("found.entries")
    tag = weak(F.col("headers")["etag"]) == weak(stored["etag"])
    date = F.col("headers")["last-modified"] == stored["last-modified"]
    agree = F.coalesce(tag, date)
    state = F.when(F.col("found").isNull(), "missing").when(agree, "resolved").when(~agree, "mismatch").otherwise("unverified")
    new = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(F.col("new"), k)), F.col("new"))
    out = found.withColumn("state", state).withColumn("new", new)
    ok = F.col("state") == "resolved"
    return out.select(
        "record_id", "canonical_url", "ts", "state", F.when(F.col("state") != "missing", F.col("found.record_id")).alias("refers_to"),
        F.when(ok, merged).otherwise(F.col("headers")).alias("headers"), *[F.when(ok, F.col(f"found.rest.`{c}`")).alias(c) for c in body],
    )


def to_warc(records: DataFrame) -> DataFrame:
    """One string column ``record``: each record of (record_id, url, ts in seconds, type, headers, body) as WARC/1.1.

    Write it with ``write_warc``. A body may be a string or binary, whose bytes are kept as they are; a null body is
    empty, null headers are none. A record_id that is no string is written as ``urn:id:`` and its digits.
    """
    urn = F.col("record_id") if dict(records.dtypes)["record_id"] == "string" else F.concat(F.lit("urn:id:"), F.col("record_id").cast("string"))
    lines = F.array_join(F.transform(F.sort_array(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>")))), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\r\n")
    block = F.concat(F.concat(F.lit("HTTP/1.1 "), F.when(F.col("type") == "revisit", "304 Not Modified").otherwise("200 OK"), F.lit("\r\n")), lines, F.lit(_END), F.coalesce(F.col("body").cast("string"), F.lit("")))
    profile = F.when(F.col("type") == "revisit", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified\r\n").otherwise("")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.col("type"), F.lit("\r\n"), profile, F.lit("WARC-Record-ID: <"), F.coalesce(urn, F.lit("")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit("\r\nWARC-Date: "), F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(_END))
    return records.select(F.concat(head, block).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """Uncompressed WARC/1.1 files, one for each partition."""
    to_warc(records).write.option("lineSep", _END).text(path)


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header lines as a map of lower-case names; values of a repeated name are joined by a comma."""
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            name, value = name.strip().lower(), value.strip()
            found[name] = f"{found[name]}, {value}" if name in found else value
    return found


_NEXT = re.compile(rb"\r\n\r\nWARC/1\.")


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """Header, block and whether it is whole, of each record of an uncompressed file.

    A block ends by its Content-Length, if that is a number and the record's end or the file's stands there. Else what
    follows goes up to the next record, so that a wrong length costs no record but its own: a block has as many bytes of it
    as the length says (none without one), and isn't whole.
    """
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = _fields(data[at:end].split(b"\r\n")[1:])
        said = head.get("content-length", "")
        size = int(said) if re.fullmatch("[0-9]{1,18}", said) else None
        start = end + 4
        stop = start + (size or 0)
        whole = size is not None and stop <= len(data) and data[stop : stop + 64].lstrip(b"\r\n")[:7] in (b"", b"WARC/1.")
        if not whole:
            found = _NEXT.search(data, end)
            stop = min(stop, found.start() if found else len(data))
            at = found.start() if found else len(data)
        yield head, data[start : max(start, stop)], whole
        at = max(at, stop) if whole else max(at, end)


def _members(data: bytes) -> Iterator[bytes]:
    """The members of a gzip file one by one, or a file that is none as it is; of a corrupt member what could be read, then the next."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data[:2] == b"\x1f\x8b":
        member, parts, at = zlib.decompressobj(31), [], 0
        try:
            while at < len(data) and not member.eof:
                parts.append(member.decompress(data[at : at + 65_536]))
                at += 65_536
            rest = member.unused_data + data[at:] if member.eof else b""
        except zlib.error:
            found = data.find(b"\x1f\x8b\x08", 2)
            rest = data[found:] if found >= 0 else b""
        yield b"".join(parts)
        data = rest


def _seconds(date: str | None) -> int | None:
    try:
        return int(datetime.fromisoformat(date).timestamp())
    except (TypeError, ValueError, OverflowError, OSError):
        return None


def _row(head: dict[str, str], block: bytes, whole: bool) -> tuple:
    kind, status, headers, body = head.get("warc-type"), None, {}, block
    if block[:5] == b"HTTP/" and kind in ("response", "revisit"):
        lines, _, body = block.partition(b"\r\n\r\n")
        first, *rest = lines.split(b"\r\n")
        code = first.split(b" ")[1:2]
        status, headers = int(code[0]) if code and code[0].isdigit() and len(code[0]) == 3 else None, _fields(rest)
    return head.get("warc-record-id", "").strip("<> ") or None, head.get("warc-target-uri", "").strip("<>") or None, _seconds(head.get("warc-date")), kind, status, list(headers.items()), body, whole


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC/1.0 and 1.1 files, plain or gzip: record_id (without brackets), url, ts, type, status, headers, body (binary), whole.

    A task reads whole files, as gzip members can't be found without reading, so files should be of the usual size, 1 GB
    or so at most. Blocks are cut by their length in bytes, whatever they hold. ``whole`` says whether a block is as long
    as its header has it; one that is cut short, or whose length is missing, comes back as far as it goes. Status and
    headers are those of HTTP responses and revisits; a date that can't be read is null.
    """
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.bool_()]
    names = ["record_id", "url", "ts", "type", "status", "headers", "body", "whole"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = (_row(*r) for m in _members(batch.column(0)[i].as_py()) for r in _records(m))
                while some := list(itertools.islice(rows, 500)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "record_id string, url string, ts long, type string, status int, headers map<string,string>, body binary, whole boolean")


def crawls(pages: DataFrame) -> DataFrame:
    """Records of two crawls of ``pages``: each page as a full response at second page_id, and a later revisit of it.

    The revisit is a million seconds behind, by another spelling of the URL, and has the page's tag, weak, but: a page
    of every 5 has changed its tag, one of every 11 sends a date of last change only and one of every 13 no validator.
    A page of every 17 was first met by a revisit, a million seconds ahead. The body is the page's hash and length.
    """
    md5 = F.md5("html")
    tag, changed = F.concat(F.lit('"'), md5, F.lit('"')), F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    id_ = F.col("page_id")
    base = pages.select("page_id", "url", tag.alias("tag"), changed.alias("changed"), F.sha2("html", 256).alias("body_sha256"), F.octet_length("html").cast("long").alias("body_bytes"))
    one = lambda k, v: F.when(v.isNotNull(), F.create_map(F.lit(k), v)).otherwise(F.create_map().cast("map<string,string>"))
    day = lambda n: F.concat(F.lit("second "), (id_ + n).cast("string"))
    response = F.struct((id_ * 3).alias("record_id"), F.col("url"), id_.alias("ts"), F.lit("response").alias("type"), F.lit(200).alias("status"), F.map_concat(one("etag", F.col("tag")), one("last-modified", F.col("changed")), one("content-type", F.lit("text/html")), one("content-length", F.col("body_bytes").cast("string")), one("date", day(0)), one("server", F.lit("first"))).alias("headers"), "body_sha256", "body_bytes")
    sent = F.when((id_ % 11 == 0) | (id_ % 13 == 0), None).when(id_ % 5 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), F.col("tag")))
    other = F.concat(F.regexp_replace("url", "^http(s?)://(www\\.)?", "HTTP$1://www."), F.when(F.col("url").contains("#"), "").when(F.col("url").contains("?"), "&utm_source=again").otherwise("?utm_source=again"))
    revisit = lambda n, k, when: F.when(when, F.struct((id_ * 3 + k).alias("record_id"), other.alias("url"), (id_ + n).alias("ts"), F.lit("revisit").alias("type"), F.lit(304).alias("status"), F.map_concat(one("etag", sent), one("last-modified", F.when(id_ % 11 == 0, F.col("changed"))), one("date", day(n)), one("cache-control", F.lit("max-age=60")), one("server", F.lit("second")), one("content-length", F.lit("0"))).alias("headers"), F.lit(None).cast("string").alias("body_sha256"), F.lit(None).cast("long").alias("body_bytes")))
    return base.select(F.explode(F.array_compact(F.array(response, revisit(1_000_000, 1, F.lit(True)), revisit(-1_000_000, 2, id_ % 17 == 0)))).alias("r")).select("r.*")


def op10_revisits(pages: DataFrame) -> DataFrame:
    """Each revisit of the two crawls: what it resolves to, and its merged headers as lines in order of name."""
    done = resolve_revisits(crawls(pages))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return done.select("record_id", "canonical_url", "state", "refers_to", lines.alias("header_lines"), "body_sha256", "body_bytes")


_CANON = """(
  WITH a AS (SELECT split_part(u, '/', 1) AS h0, substr(u, strlen(split_part(u, '/', 1)) + 1) AS r0),
  b AS (SELECT split_part(lower(split_part(h0, '?', 1)), ':', 1) AS h1, CASE WHEN h0 LIKE '%?%' THEN substr(h0, strpos(h0, '?')) || r0 ELSE r0 END AS r1 FROM a),
  c AS (SELECT CASE WHEN h1 LIKE 'www.%' AND len(string_split(h1, '.')) > 2 THEN substr(h1, 5) ELSE h1 END AS h, split_part(r1, '?', 1) AS p,
    list_filter(string_split(substr(r1, strlen(split_part(r1, '?', 1)) + 2), '&'), lambda x: x <> '' AND NOT (x LIKE 'utm\\_%' ESCAPE '\\' OR x LIKE 'fbclid=%' OR x LIKE 'gclid=%')) AS q FROM b)
  SELECT h || CASE WHEN p LIKE '%/index.html' THEN left(p, len(p) - 11) WHEN p LIKE '%/' THEN left(p, len(p) - 1) ELSE p END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END FROM c)"""
ORACLE = f"""
WITH p AS (
  SELECT page_id AS id, url, '"' || md5(html) || '"' AS tag, 'day ' || (page_id % 28) AS changed, sha256(html) AS sha, strlen(html) AS bytes FROM pages),
r AS (
  SELECT id * 3 AS record_id, url, id AS ts, 'response' AS type, tag, changed, id, sha, bytes FROM p
  UNION ALL
  SELECT id * 3 + k, regexp_replace(url, '^http(s?)://(www\\.)?', 'HTTP\\1://www.') || CASE WHEN url LIKE '%#%' THEN '' WHEN url LIKE '%?%' THEN '&utm_source=again' ELSE '?utm_source=again' END, id + n, 'revisit',
    CASE WHEN id % 11 = 0 OR id % 13 = 0 THEN NULL WHEN id % 5 = 0 THEN '"changed"' ELSE 'W/' || tag END, CASE WHEN id % 11 = 0 THEN changed END, id + n, NULL, NULL
  FROM p, (VALUES (1, 1000000), (2, -1000000)) v(k, n) WHERE k = 1 OR id % 17 = 0),
c AS (SELECT *, {_CANON} AS canonical_url FROM (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?@]*@)?', '') AS u FROM r)),
f AS (SELECT canonical_url, ts, max_by(struct_pack(record_id, tag, changed, id, sha, bytes), record_id) AS full_ FROM c WHERE type = 'response' GROUP BY ALL),
j AS (SELECT c.*, f.full_ AS f FROM c ASOF LEFT JOIN f ON c.canonical_url = f.canonical_url AND c.ts > f.ts WHERE c.type = 'revisit'),
s AS (SELECT *, CASE WHEN f IS NULL THEN 'missing' WHEN tag IS NOT NULL THEN CASE WHEN regexp_replace(tag, '^W/', '') = f.tag THEN 'resolved' ELSE 'mismatch' END
  WHEN changed IS NOT NULL THEN CASE WHEN changed = f.changed THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS state FROM j)
SELECT record_id, canonical_url, state, f.record_id AS refers_to,
  CASE WHEN state = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: ' || f.bytes, 'content-type: text/html', 'date: second ' || id, 'etag: ' || coalesce(tag, f.tag), 'last-modified: ' || coalesce(changed, f.changed), 'server: first')
    ELSE concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: 0', 'date: second ' || id, 'etag: ' || tag, 'last-modified: ' || changed, 'server: second') END AS header_lines,
  CASE WHEN state = 'resolved' THEN f.sha END AS body_sha256, CASE WHEN state = 'resolved' THEN f.bytes END AS body_bytes
FROM s"""
