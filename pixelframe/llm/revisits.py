"""Not-modified revisits of web archives, resolved by an as-of join.

A revisit stands for a capture whose body was not stored. It is resolved by the latest
earlier full response with the same canonical URL, if their validators agree, and gets that
response's headers with those that a not-modified answer may carry taken from the revisit.

The join never gathers a URL in one task: time is cut at quantiles of all records, the
latest response is looked up inside (URL, period) first, and what is left looks it up among
one row a period. So a URL with a third of all records is spread over all periods, whose
number follows the number of records. Records come from WARC files by read_warc.

Defined results. Records with a null URL or time can't be resolved (no_original). Earlier
means smaller (time, id); a response at the same time with a smaller id counts as earlier.
Outcomes: resolved, unvalidated (nothing to compare), mismatch, no_original. Repeated rows
stay. Other columns of the records are not read, so names can't clash. Records without a
time or URL are in no window.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, map_batches, table

PERIOD_ROWS = 1_000_000  # records of a period, about
RECORDS = "record_id string, url string, ts string, kind string, status int, etag string, last_modified string, digest string, headers map<string,string>"
#: Headers that a not-modified response may send anew (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def canonical_url(url: Column) -> Column:
    """host/path?query: scheme, fragment, www. or m., default port, trailing slashes and
    tracking parameters dropped, host in lower case, parameters sorted."""
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, URL, 2)), "^(www|m)[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, URL, 3), "/+$", "")
    params = F.filter(F.split(F.substring(F.regexp_extract(url, URL, 4), 2, 1 << 30), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(params), "&")
    return F.when(url.rlike(URL), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))).otherwise(url)


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def period_of(ts: Column, edges: list) -> Column:
    """How many of the sorted edges are not later: first by groups of edges, then inside one."""
    if not edges:
        return F.lit(0)
    wide = math.isqrt(len(edges)) + 1
    groups = [edges[i : i + wide] for i in range(0, len(edges), wide)]
    group = F.size(F.filter(F.array(*[F.lit(g[0]) for g in groups]), lambda e: e <= ts))
    inside = F.get(F.array(*[F.array(*[F.lit(e) for e in g]) for g in groups]), group - 1)
    return F.when(group == 0, 0).otherwise((group - 1) * wide + F.size(F.filter(inside, lambda e: e <= ts)))


def resolve(records: DataFrame, periods: int | None = None) -> DataFrame:
    """record_id, canonical_url, original_id, outcome and headers of every revisit.

    records: record_id, url, ts (orderable), kind (response or revisit), status, etag,
    last_modified, digest, headers map<string,string> with lower-case names. periods: into how
    many parts time is cut, by default one for PERIOD_ROWS records.
    """
    r = records.select("record_id", canonical_url(F.col("url")).alias("u"), "ts", "kind", "status", "etag", "last_modified", "digest", "headers")
    full = F.when((F.col("kind") == "response") & (F.col("status") == 200) & F.col("ts").isNotNull(), F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers"))
    periods = periods or max(16, -(-records.count() // PERIOD_ROWS))
    edges = r.select(F.percentile_approx("ts", [i / periods for i in range(1, periods)], max(10_000, 10 * periods)).alias("e")).first()["e"] if periods > 1 else None
    r = cut(r.withColumn("period", period_of(F.col("ts"), sorted(set(edges or [])))).withColumn("full", full))
    placed = F.col("ts").isNotNull() & F.col("u").isNotNull()
    inside = Window.partitionBy("u", "period").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = r.where(placed).withColumn("near", F.last("full", ignorenulls=True).over(inside)).unionByName(r.where(~placed).withColumn("near", F.lit(None).cast(r.schema["full"].dataType)))
    near = near.where(F.col("kind") == "revisit")
    last = r.where("full IS NOT NULL AND u IS NOT NULL").groupBy("u", "period").agg(F.max_by("full", F.struct("ts", "record_id")).alias("full"))
    # One row a URL and period: the last response before it, for every period that has revisits.
    asked = near.where("near IS NULL AND u IS NOT NULL AND ts IS NOT NULL").select("u", "period").distinct().withColumn("full", F.lit(None).cast(last.schema["full"].dataType))
    before = Window.partitionBy("u").orderBy("period").rangeBetween(Window.unboundedPreceding, -1)
    carried = last.unionByName(asked)
    carried = carried.withColumn("far", F.last("full", ignorenulls=True).over(before)).where("far IS NOT NULL").groupBy("u", "period").agg(F.first("far").alias("far"))
    found = near.join(carried, ["u", "period"], "left").withColumn("o", F.when(F.col("u").isNotNull() & F.col("ts").isNotNull(), F.coalesce("near", "far")))
    agree = F.coalesce(weak(F.col("etag")) == weak(F.col("o.etag")), F.col("last_modified") == F.col("o.last_modified"), F.col("digest") == F.col("o.digest"))
    outcome = F.when(F.col("o").isNull(), "no_original").when(agree.isNull(), "unvalidated").when(agree, "resolved").otherwise("mismatch")
    sent = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce("o.headers", F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(sent), k))
    return found.select("record_id", F.col("u").alias("canonical_url"), "o", sent.alias("sent"), kept.alias("kept"), outcome.alias("outcome")).select(
        "record_id", "canonical_url", F.when(F.col("outcome") != "mismatch", F.col("o.record_id")).alias("original_id"), "outcome",
        F.when(F.col("outcome").isin("resolved", "unvalidated"), F.map_concat("kept", "sent")).alias("headers"),
    )


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a WARC file, plain or
    compressed record by record; only one record is expanded at a time. A broken tail ends it."""

    def members() -> Iterator[bytes]:
        if not data.startswith(b"\x1f\x8b"):
            yield data
            return
        rest = memoryview(data)
        while len(rest):
            one = zlib.decompressobj(31)
            try:
                out = one.decompress(rest)
            except zlib.error:
                return
            yield out
            rest = rest[len(rest) - len(one.unused_data) :] if one.eof else rest[:0]

    for text in members():
        at = 0
        while (start := text.find(b"WARC/", at)) >= 0:
            end = text.find(b"\r\n\r\n", start)
            if end < 0:
                break
            lines = text[start:end].decode("utf-8", "replace").split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            size = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else 0
            yield fields, text[end + 4 : end + 4 + size]
            at = end + 4 + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits of WARC files, as resolve() takes them; ts is the record's
    date, null if it is malformed. A file is one row of Spark's binary reader, so it may have 2 GB at most, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.string()] * 4 + [pa.int32()] + [pa.string()] * 3 + [pa.map_(pa.string(), pa.string())]
        for b in batches:
            out: list[tuple] = []
            for data in b.column("content"):
                for f, block in warc_records(data.as_py() or b""):
                    if f.get("warc-type") not in ("response", "revisit"):
                        continue
                    lines = block.split(b"\r\n\r\n", 1)[0].decode("latin-1").split("\r\n")
                    status = lines[0].split(" ")[1:2]
                    headers = {k.strip().lower(): v.strip() for k, s, v in (x.partition(":") for x in lines[1:]) if s}
                    code = int(status[0]) if status and status[0].isdigit() else None
                    out.append((f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-date"), f["warc-type"], code, headers.get("etag"), headers.get("last-modified"), f.get("warc-payload-digest"), list(headers.items())))
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return map_batches(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content"), run, RECORDS).withColumn("ts", F.col("ts").try_cast("timestamp"))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records made of pages: each page is a full response at time 10 * id, followed by
    revisits at +3 (same validators), +4 (another tag, every fifth page) and, for every
    seventh page, one of the page's canonical form that comes before the response."""
    p, digest = F.col("page_id"), F.md5(F.coalesce("html", F.lit("")))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 8), F.lit('"'))
    head = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    day = F.concat(F.lit("day-"), p.cast("string"))
    shapes = F.filter(
        F.array(
            F.struct((p * 4).alias("record_id"), (p * 10).alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"), tag.alias("etag"), F.lit(None).cast("string").alias("last_modified"), digest.alias("digest"), head("content-type", "text/html", "date", day, "etag", tag).alias("headers")),
            F.struct((p * 4 + 1).alias("record_id"), (p * 10 + 3).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), F.concat(F.lit("W/"), tag).alias("etag"), F.lit(None).cast("string").alias("last_modified"), digest.alias("digest"), head("server", "x", "date", F.concat(day, F.lit("b"))).alias("headers")),
            F.struct((p * 4 + 2).alias("record_id"), F.when(p % 5 == 0, p * 10 + 4).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), F.lit('"other"').alias("etag"), F.lit(None).cast("string").alias("last_modified"), digest.alias("digest"), head("date", F.concat(day, F.lit("c"))).alias("headers")),
            F.struct((p * 4 + 3).alias("record_id"), F.when(p % 7 == 0, p * 10 - 1).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("string").alias("digest"), head("date", F.concat(day, F.lit("d"))).alias("headers")),
        ),
        lambda s: s["ts"].isNotNull(),
    )
    return pages.select("url", F.explode(shapes).alias("s")).select("url", "s.*")


def op5_warc_revisits(spark, sf_dir: str) -> DataFrame:
    out = resolve(captures(table(spark, sf_dir, "pages")))
    text = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return out.select("record_id", "canonical_url", "original_id", "outcome", text.alias("headers"))


_MADE = """WITH made AS (
SELECT page_id AS p, url, md5(coalesce(html, '')) AS digest, '"' || substr(md5(coalesce(html, '')), 1, 8) || '"' AS tag FROM pages),
u AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 2)), '^(www|m)[.]', ''), ':(80|443)$', '') || regexp_replace(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 3), '/+$', '') AS base,
 list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS q FROM made),
c AS (SELECT *, CASE WHEN NOT regexp_matches(url, '^([A-Za-z][A-Za-z0-9+.-]*)://') THEN url WHEN len(q) > 0 THEN base || '?' || array_to_string(q, '&') ELSE base END AS canonical_url FROM u),
r AS (SELECT p * 4 AS record_id, p * 10 AS ts, 'response' AS kind, canonical_url, tag AS etag, digest, 'day-' || p AS day FROM c
UNION ALL SELECT p * 4 + 1, p * 10 + 3, 'revisit', canonical_url, tag, digest, 'day-' || p || 'b' FROM c
UNION ALL SELECT p * 4 + 2, p * 10 + 4, 'revisit', canonical_url, '"other"', digest, 'day-' || p || 'c' FROM c WHERE p % 5 = 0
UNION ALL SELECT p * 4 + 3, p * 10 - 1, 'revisit', canonical_url, NULL, NULL, 'day-' || p || 'd' FROM c WHERE p % 7 = 0),
j AS (SELECT v.*, f.record_id AS oid, f.etag AS otag, f.digest AS odigest, row_number() OVER (PARTITION BY v.record_id ORDER BY f.ts DESC, f.record_id DESC) AS n
FROM r v LEFT JOIN r f ON f.kind = 'response' AND f.canonical_url = v.canonical_url AND (f.ts < v.ts OR (f.ts = v.ts AND f.record_id < v.record_id)) WHERE v.kind = 'revisit'),
o AS (SELECT *, CASE WHEN oid IS NULL THEN 'no_original' WHEN coalesce(etag = otag, digest = odigest) IS NULL THEN 'unvalidated' WHEN coalesce(etag = otag, digest = odigest) THEN 'resolved' ELSE 'mismatch' END AS outcome FROM j WHERE n = 1)
"""
OP5_SQL = _MADE + "SELECT record_id, canonical_url, CASE WHEN outcome <> 'mismatch' THEN oid END AS original_id, outcome, CASE WHEN outcome IN ('resolved', 'unvalidated') THEN 'content-type=text/html;date=' || day || ';etag=' || otag END AS headers FROM o"
