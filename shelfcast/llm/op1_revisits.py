"""WARC not-modified revisits, resolved by an as-of join to the latest earlier full response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import materialize

#: Seconds of a time bucket: one task orders a URL's records of one bucket.
BUCKET_S = 86_400

# Query parameters that name a visit, not a resource.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "ref", "sessionid", "phpsessid", "jsessionid", "sid")
# Fields of a stored response that a 304 response doesn't replace (they describe the body or the hop).
NOT_UPDATED = ("content-length", "content-encoding", "content-type", "content-range", "content-md5", "transfer-encoding", "connection",
               "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "upgrade")


def canonical_url(url: Column) -> Column:
    """One key for the spellings of a URL.

    White space around and the fragment go; scheme, ``www`` host prefix, user and default
    port go; host in lower case; tracking parameters go and the others are sorted; an empty path is ``/``, and
    other paths lose their last ``/``.  Null stays null.
    """
    s = F.regexp_replace(F.btrim(url), "#.*$", "")
    s = F.regexp_replace(s, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(s, r"^([^/?]*)", 1)
    host = F.regexp_replace(F.lower(authority), r"^.*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\d*\.", "")
    rest = F.substring_index(s, "?", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/]*(.*)$", 1), r"/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.when(F.instr(s, "?") > 0, F.regexp_replace(s, r"^[^?]*\?", "")).otherwise("")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(*TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def lower_keys(headers: Column) -> Column:
    """The header fields by lower-case name; of names that differ in case only, the smallest spelling's value."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), 1)["value"].alias("value"))))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored fields with those of the 304 response put over them, as far as these may be updated."""
    permitted = F.map_filter(update, lambda k, _: ~k.isin(*NOT_UPDATED))
    kept = F.map_filter(stored, lambda k, _: ~F.map_contains_key(permitted, k))
    return F.map_concat(kept, permitted)


def _weak(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.btrim(tag), "^W/", "")


def resolve_revisits(records: DataFrame, bucket_s: int = BUCKET_S) -> DataFrame:
    """Resolve the not-modified revisits among ``records``.

    ``records``: record_id (string), kind ('response' or 'revisit'), url, date
    (timestamp), status (int), headers (map), payload_digest (string).  One row per
    revisit: (record_id, canonical_url, date, outcome, refers_to, refers_to_date,
    payload_digest, headers).

    A revisit's candidate is the latest response of its canonical URL with status
    200 and a strictly earlier date (of equal dates, the largest record_id).  Its
    validators are checked in turn: the entity tag (weak comparison) if both have
    one, else Last-Modified if both have it, else the payload digest if both have
    it.  ``outcome`` is 'resolved', 'mismatch' (a validator differs), 'unvalidated'
    (none can be compared) or 'no_response' (no candidate).  Only resolved rows
    refer to a record and carry its digest and the merged headers; bodies stay where
    they are and are joined by ``refers_to`` (:func:`with_bodies`).

    The as-of join is no join of all pairs and keeps no URL in one task.  Records of one URL and date
    become one moment with its last response, an aggregate that is partial on the map side, so
    that any number of them is one row.  Moments are ordered within (URL, time bucket), where
    they are at most the distinct dates of ``bucket_s`` seconds, and each bucket's last response
    is carried over the URL's buckets.  Revisits then meet their moment by an equi-join.

    Defined results: records without a date or URL have no candidate and are none;
    a revisit without headers has none to compare; repeated rows are resolved each;
    an empty table gives an empty result; other columns are ignored.
    """
    own = records.select(
        "record_id", "kind", "url", canonical_url(F.col("url")).alias("canonical_url"), "date", "status",
        lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"), "payload_digest")
    own = own.withColumn("second", F.unix_micros(F.col("date").cast("timestamp")))
    placed = F.col("url").isNotNull() & F.col("second").isNotNull()
    # ordered by id; maps can't be compared, so the header fields go as text
    ref = F.struct("second", "record_id", "date", "payload_digest", F.to_json("headers").alias("headers"))
    ref = F.when((F.col("kind") == "response") & (F.col("status") == 200), ref)
    key, revisit = ["canonical_url", "bucket"], F.col("kind") == "revisit"
    moments = own.where(placed & (ref.isNotNull() | revisit)).groupBy("canonical_url", "second").agg(F.max(ref).alias("ref"), F.max(revisit).alias("asked"))
    # three branches read them: written, so that the records are looked through once for them
    moments = materialize(moments.withColumn("bucket", F.floor(F.col("second") / (bucket_s * 1_000_000))), "op1-moments")

    # the last response of each bucket, then of all buckets before
    last = moments.where("ref is not null").groupBy(*key).agg(F.max("ref").alias("last"))
    over = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = moments.where("asked").select(*key).distinct().join(last, key, "full")
    carried = carried.withColumn("carried", F.last("last", ignorenulls=True).over(over)).select(*key, "carried")

    # within a bucket: the moments before, so that equal dates don't see each other
    inside = Window.partitionBy(*key).orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    seen = moments.withColumn("near", F.last("ref", ignorenulls=True).over(inside)).where("asked")
    met = seen.join(carried, key, "left").select("canonical_url", "second", F.coalesce("near", "carried").alias("found"))

    # revisits without a URL or date meet nothing and stay out of the join: all of them would be one key
    asking = own.where(revisit)
    nothing = F.lit(None).cast(met.schema["found"].dataType)
    found = asking.where(placed).join(met, ["canonical_url", "second"], "left").unionByName(asking.where(~placed).withColumn("found", nothing))

    mine, theirs = F.col("headers"), F.from_json("found.headers", "map<string,string>")
    tag_a, tag_b = _weak(F.try_element_at(mine, F.lit("etag"))), _weak(F.try_element_at(F.col("stored"), F.lit("etag")))
    time_a, time_b = F.try_element_at(mine, F.lit("last-modified")), F.try_element_at(F.col("stored"), F.lit("last-modified"))
    same = F.coalesce(tag_a == tag_b, time_a == time_b, F.col("payload_digest") == F.col("found.payload_digest"))
    outcome = F.when(F.col("found").isNull(), "no_response").when(same.isNull(), "unvalidated").when(same, "resolved").otherwise("mismatch")
    out = found.withColumn("stored", theirs).withColumn("outcome", outcome)
    hit = F.col("outcome") == "resolved"
    return out.select(
        "record_id", "canonical_url", "date", "outcome", F.when(hit, F.col("found.record_id")).alias("refers_to"), F.when(hit, F.col("found.date")).alias("refers_to_date"),
        F.when(hit, F.col("found.payload_digest")).alias("payload_digest"), F.when(hit, merged_headers(F.col("stored"), mine)).alias("headers"))


def with_bodies(resolved: DataFrame, bodies: DataFrame) -> DataFrame:
    """Resolved revisits with the column ``body`` of ``bodies(record_id, body)``."""
    return resolved.join(bodies.select(F.col("record_id").alias("refers_to"), "body"), "refers_to", "left")


def crawl_records(pages: DataFrame) -> DataFrame:
    """WARC records derived from ``pages(page_id, url, html)``: a response and a later revisit of every page.

    A page is fetched at minute ``page_id`` and asked for again up to 70 days later,
    by its own URL, with its entity tag, its date or only its digest as validator, by turns
    of the id; so the latest earlier response of the canonical URL is often another page's.
    """
    minute, digest = F.col("page_id") * 60, F.md5(F.coalesce("html", F.lit("")))
    date = lambda s: F.timestamp_seconds(F.lit(1_704_067_200) + s)

    def http(seconds):
        clock = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        return F.date_format(clock, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")

    turn = F.pmod(F.col("page_id"), F.lit(4))
    tag, since = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"')), http(F.pmod(minute, F.lit(5_000_000)))
    later = minute + 30 + F.pmod(F.col("page_id") * 7919, F.lit(100_003)) * 60

    def fields(*pairs):
        return F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs]), lambda e: e["value"].isNotNull()))

    response = pages.select(
        F.concat(F.lit("a"), F.col("page_id").cast("string")).alias("record_id"), F.lit("response").alias("kind"), "url", date(minute).alias("date"),
        F.when(F.pmod(F.col("page_id"), F.lit(29)) == 7, 503).otherwise(200).alias("status"),
        fields(("Content-Type", F.lit("text/html")), ("Content-Length", F.octet_length("html")), ("ETag", F.when(turn < 2, tag)),
               ("Last-Modified", F.when(turn != 3, since)), ("Cache-Control", F.lit("max-age=60")), ("Date", http(minute))).alias("headers"),
        digest.alias("payload_digest"))
    revisit = pages.select(
        F.concat(F.lit("b"), F.col("page_id").cast("string")).alias("record_id"), F.lit("revisit").alias("kind"), "url", date(later).alias("date"), F.lit(304).alias("status"),
        fields(("etag", F.when(turn == 0, F.concat(F.lit("W/"), tag)).when(turn == 1, tag)), ("last-modified", F.when(turn == 2, since)),
               ("Content-Length", F.lit("0")), ("cache-control", F.lit("max-age=90")), ("Date", http(later)), ("Age", F.when(turn == 1, turn))).alias("headers"),
        F.when(turn == 3, digest).alias("payload_digest"))
    return response.unionByName(revisit)


def op1_revisits(pages: DataFrame) -> DataFrame:
    """One row per revisit: (record_id, canonical_url, outcome, refers_to, age_s, payload_digest, headers_sha256)."""
    rows = resolve_revisits(crawl_records(pages))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"])))
    age = ((F.unix_micros("date") - F.unix_micros("refers_to_date")) / 1_000_000).cast("long")
    return rows.select("record_id", "canonical_url", "outcome", "refers_to", age.alias("age_s"), "payload_digest",
                       F.sha2(F.array_join(entries, "\n"), 256).alias("headers_sha256"))


_TRACKING_SQL = ", ".join(f"'{t}'" for t in TRACKING)
ORACLE = rf"""
WITH p AS (
  SELECT page_id, url, html, md5(coalesce(html, '')) AS digest, page_id % 4 AS turn, page_id * 60 AS asked,
         page_id * 60 + 30 + (page_id * 7919 % 100003) * 60 AS later, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages),
c AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)?$', ''), '^www[0-9]*\.', '') AS host,
         regexp_replace(regexp_extract(split_part(bare, '?', 1), '^[^/]*(.*)$', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(CASE WHEN contains(bare, '?') THEN regexp_replace(bare, '^[^?]*\?', '') ELSE '' END, '&'),
           lambda x: x <> '' AND NOT list_contains([{_TRACKING_SQL}], lower(split_part(x, '=', 1))))) AS query FROM p),
u AS (
  SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical_url,
         '"' || digest[1:16] || '"' AS tag,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(asked % 5000000), '%a, %d %b %Y %H:%M:%S GMT') AS since,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(later), '%a, %d %b %Y %H:%M:%S GMT') AS later_date FROM c),
j AS (
  SELECT v.page_id AS v, r.page_id AS r, row_number() OVER (PARTITION BY v.page_id ORDER BY r.asked DESC NULLS LAST) AS n
  FROM u v LEFT JOIN u r ON v.canonical_url = r.canonical_url AND r.asked < v.later AND r.page_id % 29 <> 7),
o AS (
  SELECT v.*, r.page_id AS ref, r.digest AS ref_digest, r.asked AS ref_asked, octet_length(encode(r.html)) AS ref_size, r.turn AS ref_turn, r.tag AS ref_tag, r.since AS ref_since,
         coalesce(CASE WHEN v.turn < 2 AND r.turn < 2 THEN v.tag = r.tag END, CASE WHEN v.turn = 2 AND r.turn <> 3 THEN v.since = r.since END,
                  CASE WHEN v.turn = 3 THEN v.digest = r.digest END) AS same
  FROM j JOIN u v ON j.v = v.page_id LEFT JOIN u r ON j.r = r.page_id WHERE n = 1),
h AS (
  SELECT *, CASE WHEN ref IS NULL THEN 'no_response' WHEN same IS NULL THEN 'unvalidated' WHEN same THEN 'resolved' ELSE 'mismatch' END AS outcome FROM o)
SELECT 'b' || page_id AS record_id, canonical_url, outcome, CASE WHEN same THEN 'a' || ref END AS refers_to, CASE WHEN same THEN later - ref_asked END AS age_s,
       CASE WHEN same THEN ref_digest END AS payload_digest,
       CASE WHEN same THEN sha256(array_to_string(list_sort(list_filter([
         'content-type: text/html', 'content-length: ' || ref_size, 'cache-control: max-age=90', 'date: ' || later_date,
         CASE WHEN turn = 0 THEN 'etag: W/' || tag WHEN turn = 1 THEN 'etag: ' || tag WHEN ref_turn < 2 THEN 'etag: ' || ref_tag END,
         CASE WHEN turn = 2 THEN 'last-modified: ' || since WHEN ref_turn <> 3 THEN 'last-modified: ' || ref_since END,
         CASE WHEN turn = 1 THEN 'age: 1' END], lambda x: x IS NOT NULL)), chr(10))) END AS headers_sha256
FROM h
"""
