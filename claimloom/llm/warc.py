"""Resolution of not-modified revisits in WARC captures.

A revisit record of the server-not-modified kind has headers but no body. Its body is that of the latest earlier
full response of the same canonical URL, if the validators agree. The as-of join runs in range partitions of
(URL, time): a window finds the base within a partition, and one row for each partition and URL carries the last
response over to the next. A URL with any share of all rows is thus spread over as many tasks as its size needs.
Only keys, times and validators are sorted; bodies and headers join last, by the base's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import kept, table

#: Headers that a 304 response may update (fixed values of the HTTP standard).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Host and path in one spelling: no scheme, user, www., default port, fragment or tracking parameters; parameters sorted; no closing slash.

    Null stays null; text that is no URL is lower-cased up to its first slash like a host.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    kept_ = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike("^utm_")))
    return F.concat(host, path, F.when(F.size(kept_) > 0, F.concat(F.lit("?"), F.array_join(kept_, "&"))).otherwise(""))


def plain_tag(etag: Column) -> Column:
    """An entity tag for the weak comparison."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def small_names(headers: Column) -> Column:
    """Headers with names in small letters; of names that differ in case only the spelling that sorts last wins. A null map is empty."""
    low = F.transform(F.array_sort(F.map_entries(F.coalesce(headers, F.expr("map()").cast("map<string,string>")))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(low, lambda e: e["key"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(low, lambda e: e["key"] == n), -1)["value"]))


def merged_headers(base: Column, update: Column) -> Column:
    """The base's headers, names in small letters, with the permitted ones of the update in their place."""
    new = F.map_filter(small_names(update), lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(small_names(base), lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each record: record_id, url_key, outcome, base_id, headers and body.

    `records` has record_id, url, ts (any ordered type), kind ('response' is a full response, all else a revisit),
    etag, last_modified, headers (map<string,string>) and body; other columns are left out. outcome is `response`; or
    for a revisit `resolved` (its tag, or without one its date, equals the base's), `unchecked` (it names no
    validator), `mismatch` or `no_base`. Earlier is by time, then responses first, then record_id. A null URL or
    time has no base and is none. Only resolved and unchecked revisits get the base's body and merged headers; the
    rest keep their own headers and a null body. Of header names that differ in case only, the spelling that
    sorts last wins when headers are merged. Repeated rows each give a row, with their own headers; record_ids may be
    null or repeated, and of responses of one URL, time and record_id any serves as the base. An empty table gives
    an empty one.
    """
    full = F.col("kind").eqNullSafe("response")
    keys = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", full.alias("full"), plain_tag(F.col("etag")).alias("etag"), "last_modified", F.when(~full, F.col("headers")).alias("own"))
    order = ["ts", F.col("full").desc(), "record_id"]
    dealt = kept(keys.repartitionByRange("url_key", *order).withColumn("part", F.spark_partition_id()), "captures")
    may_base = F.col("full") & F.col("ts").isNotNull() & F.col("url_key").isNotNull()
    here = F.when(may_base, F.struct(F.col("record_id").alias("id"), F.col("ts").alias("ts"), F.col("etag").alias("etag"), F.col("last_modified").alias("modified")))
    before = Window.partitionBy("part", "url_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    based = dealt.withColumn("near", F.last(here, ignorenulls=True).over(before)).where("not full")
    ends = dealt.groupBy("part", "url_key").agg(F.max_by(here, F.when(may_base, F.struct("ts", (~F.col("full")).alias("later"), "record_id"))).alias("end"))
    carried = ends.select("part", "url_key", F.last("end", ignorenulls=True).over(Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carry")).where("carry is not null")
    found = based.join(carried, ["part", "url_key"], "left").withColumn("base", F.when(F.col("ts").isNotNull(), F.coalesce("near", "carry")))
    agree = F.when(F.col("etag").isNotNull(), F.col("etag").eqNullSafe(F.col("base.etag"))).when(F.col("last_modified").isNotNull(), F.col("last_modified").eqNullSafe(F.col("base.modified")))
    outcome = F.when(F.col("base").isNull(), "no_base").when(agree.isNull(), "unchecked").when(agree, "resolved").otherwise("mismatch")
    revisits = found.select("record_id", "url_key", outcome.alias("outcome"), F.col("base.id").alias("base_id"), F.col("base.ts").alias("base_ts"), "own")
    # Rows without a usable base stay out of the join by base, where they would all meet in one task.
    usable = F.col("outcome").isin("resolved", "unchecked")
    responses = records.where(full).select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "headers", "body")
    bases = responses.select(F.col("record_id").alias("its_id"), F.col("url_key").alias("its_key"), F.col("ts").alias("its_ts"), F.col("headers").alias("base_headers"), "body").dropDuplicates(["its_id", "its_key", "its_ts"])
    same = F.col("base_id").eqNullSafe(F.col("its_id")) & (F.col("url_key") == F.col("its_key")) & (F.col("base_ts") == F.col("its_ts"))
    joined = revisits.where(usable).join(bases, same, "left").select("record_id", "url_key", "outcome", "base_id", merged_headers(F.col("base_headers"), F.col("own")).alias("headers"), "body")
    rest = revisits.where(~usable).select("record_id", "url_key", "outcome", "base_id", F.col("own").alias("headers"), F.lit(None).cast(dict(records.dtypes)["body"]).alias("body"))
    plain = responses.select("record_id", "url_key", F.lit("response").alias("outcome"), F.lit(None).cast(dict(records.dtypes)["record_id"]).alias("base_id"), "headers", "body")
    return plain.unionByName(joined).unionByName(rest)


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A capture log over the pages table, for want of one in the test data.

    Each page is a full response, at a time that follows its id. Every second page is revisited a day later under
    another spelling of its URL; every fifth has a revisit with another tag; every seventh one before its response;
    every third a weakly tagged one. And each page's visit fetches its host's robots.txt: the ids divisible by ten
    as full responses, the others as revisits, so the largest host's file has a large share of all records.
    """
    host = F.regexp_extract("url", "://([^/]+)", 1)
    rest = F.regexp_extract("url", "://[^/]+([^#]*)", 1)
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    at = F.col("page_id") * 60
    robots = F.concat(F.lit("robots of "), host, F.lit(" at "), F.floor(F.col("page_id") / 1000).cast("string"))
    headers = lambda *kv: F.create_map(*(x if isinstance(x, Column) else F.lit(x) for x in kv))
    none, day = F.lit(None).cast("string"), 86_400

    def record(k, url, ts, kind, etag, modified, head, body):
        return F.struct((F.col("page_id") * 8 + k).alias("record_id"), url.alias("url"), ts.alias("ts"), F.lit(kind).alias("kind"), etag.alias("etag"), modified.alias("last_modified"), head.alias("headers"), body.alias("body"))

    size = F.length("html").cast("string")
    date = lambda ts: F.concat(F.lit("t"), ts.cast("string"))
    robot_url, robot_tag = F.concat(F.lit("http://"), host, F.lit("/robots.txt")), F.concat(F.lit('"'), F.md5(robots), F.lit('"'))
    fetched = F.col("page_id") % 10 == 0
    made = F.array(
        record(0, F.col("url"), at, "response", tag, date(at), headers("Content-Type", "text/html", "Content-Length", size, "ETag", tag, "Cache-Control", "max-age=60", "Date", date(at)), F.col("html")),
        F.when(F.col("page_id") % 2 == 0, record(1, F.concat(F.lit("HTTPS://WWW."), F.upper(host), F.lit(":443"), rest, F.lit("#again")), at + day, "revisit", tag, none, headers("Date", date(at + day), "Cache-Control", "max-age=90", "Content-Length", "0"), none)),
        F.when(F.col("page_id") % 5 == 0, record(2, F.col("url"), at + 2 * day, "revisit", F.lit('"other"'), none, headers("Date", date(at + 2 * day)), none)),
        F.when(F.col("page_id") % 7 == 0, record(3, F.col("url"), at - day, "revisit", tag, none, headers("Date", date(at - day)), none)),
        F.when(F.col("page_id") % 3 == 0, record(4, F.col("url"), at + 3 * day, "revisit", F.concat(F.lit("W/"), tag), none, headers("date", date(at + 3 * day), "Vary", "Accept", "Set-Cookie", "a=b"), none)),
        F.when(fetched, record(5, robot_url, at, "response", robot_tag, date(at), headers("Content-Type", "text/plain", "Date", date(at)), robots)),
        F.when(~fetched, record(6, robot_url, at, "revisit", none, F.when(F.col("page_id") % 4 == 0, date(at)), headers("Date", date(at), "Expires", "never"), none)),
    )
    return pages.select(F.explode(F.filter(made, lambda r: r.isNotNull())).alias("r")).select("r.*")


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every capture of the pages' log with its outcome, base, and the digest of its resolved headers and body."""
    found = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(F.lower(e["key"]), F.lit(": "), e["value"]))), "\n")
    return found.select("record_id", "url_key", "outcome", "base_id", F.size("headers").cast("long").alias("n_headers"), F.md5(lines).alias("headers_md5"), F.md5("body").alias("body_md5"))


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, html, regexp_extract(url, '://([^/]+)', 1) AS host, regexp_extract(url, '://[^/]+([^#]*)', 1) AS rest,
         '"' || md5(html) || '"' AS tag, page_id * 60 AS seen, CAST(length(html) AS VARCHAR) AS size
  FROM pages),
q AS (SELECT *, 'robots of ' || host || ' at ' || CAST(page_id // 1000 AS VARCHAR) AS robots FROM p),
rec AS (
  SELECT page_id * 8 AS record_id, url, seen AS ts, true AS full_, tag AS etag, 't' || seen AS lm,
         MAP {'content-type': 'text/html', 'content-length': size, 'etag': tag, 'cache-control': 'max-age=60', 'date': 't' || seen} AS h, html AS body FROM q
  UNION ALL SELECT page_id * 8 + 1, 'HTTPS://WWW.' || upper(host) || ':443' || rest || '#again', seen + 86400, false, tag, NULL,
         MAP {'date': 't' || (seen + 86400), 'cache-control': 'max-age=90', 'content-length': '0'}, NULL FROM q WHERE page_id % 2 = 0
  UNION ALL SELECT page_id * 8 + 2, url, seen + 172800, false, '"other"', NULL, MAP {'date': 't' || (seen + 172800)}, NULL FROM q WHERE page_id % 5 = 0
  UNION ALL SELECT page_id * 8 + 3, url, seen - 86400, false, tag, NULL, MAP {'date': 't' || (seen - 86400)}, NULL FROM q WHERE page_id % 7 = 0
  UNION ALL SELECT page_id * 8 + 4, url, seen + 259200, false, tag, NULL, MAP {'date': 't' || (seen + 259200), 'vary': 'Accept', 'set-cookie': 'a=b'}, NULL FROM q WHERE page_id % 3 = 0
  UNION ALL SELECT page_id * 8 + 5, 'http://' || host || '/robots.txt', seen, true, '"' || md5(robots) || '"', 't' || seen, MAP {'content-type': 'text/plain', 'date': 't' || seen}, robots FROM q WHERE page_id % 10 = 0
  UNION ALL SELECT page_id * 8 + 6, 'http://' || host || '/robots.txt', seen, false, NULL, CASE WHEN page_id % 4 = 0 THEN 't' || seen END, MAP {'date': 't' || seen, 'expires': 'never'}, NULL FROM q WHERE page_id % 10 <> 0),
k AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM rec),
u AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^utm_'))) AS args,
         regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
           || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place FROM k),
c AS (SELECT *, place || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS url_key FROM u),
b AS (
  SELECT *, last_value(CASE WHEN full_ THEN record_id END IGNORE NULLS) OVER (PARTITION BY url_key ORDER BY ts, full_ DESC, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near FROM c),
d AS (
  SELECT r.*, CASE WHEN r.full_ THEN NULL ELSE r.near END AS base_id, x.h AS bh, x.body AS bbody,
         CASE WHEN r.full_ THEN 'response' WHEN r.near IS NULL THEN 'no_base' WHEN r.etag IS NOT NULL THEN CASE WHEN r.etag = x.etag THEN 'resolved' ELSE 'mismatch' END
              WHEN r.lm IS NOT NULL THEN CASE WHEN r.lm = x.lm THEN 'resolved' ELSE 'mismatch' END ELSE 'unchecked' END AS outcome
  FROM b r LEFT JOIN c x ON x.record_id = r.near AND NOT r.full_),
e AS (
  SELECT *, CASE WHEN outcome IN ('resolved', 'unchecked') THEN
      list_concat(list_filter(map_entries(bh), lambda y: NOT (y.key IN ('cache-control', 'content-location', 'date', 'etag', 'expires', 'last-modified', 'vary') AND list_contains(map_keys(h), y.key))),
                  list_filter(map_entries(h), lambda y: y.key IN ('cache-control', 'content-location', 'date', 'etag', 'expires', 'last-modified', 'vary')))
    ELSE map_entries(h) END AS hs,
    CASE WHEN outcome IN ('resolved', 'unchecked') THEN bbody WHEN outcome = 'response' THEN body END AS out_body FROM d)
SELECT record_id, url_key, outcome, base_id, CAST(len(hs) AS BIGINT) AS n_headers,
       md5(array_to_string(list_sort(list_transform(hs, lambda y: y.key || ': ' || y.value)), chr(10))) AS headers_md5, md5(out_body) AS body_md5
FROM e
"""
