"""WARC: resolves not-modified revisits to the full responses they stand for.

A revisit (304) belongs to the latest earlier full response (200) of the same canonical URL, in the order of time and
record id. Its validators are checked against that response, and the headers that a 304 may change are merged into the
response's. The as-of join runs in slices of fixed length of each URL's time: within a slice as a window, across
slices by the last response of each earlier slice, so a URL with very many records is many small windows.

Records: record_id, type (response or revisit), url, ts (seconds), status, etag, last_modified, headers (map of lower-case
names). Edge cases: records without url, time or type are left out; a missing header map counts as empty; repeated
records give a row each; of records with equal time and id any order may hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 3600
#: Headers that a 304 response may carry for the stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that do not name another document.
TRACKING = r"^(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)(?:=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without slash at its end, other parameters in order; no
    scheme, fragment or tracking parameter."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _plain(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolved(records: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """A row per revisit: record_id, canonical_url, ts, response_id, response_ts, outcome and headers.

    outcome: resolved (an entity tag, or else a modification date, is equal), mismatch (it differs), unchecked (nothing to
    compare), no_response. headers: the response's with the permitted ones of the revisit, where the outcome is resolved
    or unchecked; else null."""
    empty = F.create_map().cast("map<string,string>")
    rows = records.select(
        "record_id", "type", F.col("ts").cast("long").alias("ts"), canonical_url(F.col("url")).alias("key"), "etag",
        F.col("last_modified").cast("string").alias("last_modified"), F.coalesce("headers", empty).alias("headers"),
        (F.col("status") == 200).alias("full"),
    ).filter(F.col("key").isNotNull() & F.col("ts").isNotNull() & F.col("type").isin("response", "revisit"))
    response = F.when(
        (F.col("type") == "response") & F.col("full"), F.struct("ts", "record_id", "etag", "last_modified", "headers")
    )
    rows = rows.withColumn("response", response).withColumn("slice", F.floor(F.col("ts") / seconds))
    earlier = Window.partitionBy("key", "slice").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    in_slice = rows.withColumn("near", F.last("response", ignorenulls=True).over(earlier)).filter(F.col("type") == "revisit")
    last = rows.filter("response is not null").groupBy("key", "slice").agg(F.max_by("response", F.struct("ts", "record_id")).alias("response"))
    stops = last.unionByName(in_slice.filter("near is null").select("key", "slice").distinct().withColumn("response", F.lit(None).cast(last.schema["response"].dataType)))
    across = Window.partitionBy("key").orderBy("slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = stops.withColumn("carried", F.last("response", ignorenulls=True).over(across)).filter("carried is not null").groupBy("key", "slice").agg(F.first("carried").alias("carried"))
    joined = in_slice.drop("response").join(carried, ["key", "slice"], "left").withColumn("r", F.coalesce("near", "carried"))
    by_tag = F.col("etag").isNotNull() & F.col("r.etag").isNotNull()
    by_date = F.col("last_modified").isNotNull() & F.col("r.last_modified").isNotNull()
    same = F.when(by_tag, _plain(F.col("etag")) == _plain(F.col("r.etag"))).when(by_date, F.col("last_modified") == F.col("r.last_modified"))
    outcome = F.when(F.col("r").isNull(), "no_response").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("mismatch")
    permitted = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    rest = F.map_filter("r.headers", lambda k, v: ~F.map_contains_key(permitted, k))
    return joined.select(
        "record_id", F.col("key").alias("canonical_url"), "ts", F.col("r.record_id").alias("response_id"), F.col("r.ts").alias("response_ts"),
        outcome.alias("outcome"), F.when(outcome.isin("resolved", "unchecked"), F.map_concat(rest, permitted)).alias("headers"),
    )


def header_lines(headers: Column) -> Column:
    """A header map as lines in order of names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def page_records(pages: DataFrame) -> DataFrame:
    """Records as a crawler that visits every page twice would write them: a response per page and, some time later, a
    revisit of another spelling of its URL; some servers send no entity tag, a weak one, or one that has changed."""
    page = F.col("page_id")
    at = page * 600
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    nothing = F.lit(None).cast("string")
    pairs = lambda **kv: F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in kv]), F.array(*kv.values()))
    responses = pages.select(
        (page * 2).alias("record_id"), F.lit("response").alias("type"), "url", at.alias("ts"), F.lit(200).alias("status"),
        F.when(page % 5 == 0, nothing).otherwise(tag).alias("etag"), F.when(page % 7 == 0, F.lit(None)).otherwise(at - 86400).alias("last_modified"),
        pairs(content_type=F.lit("text/html"), content_length=F.length("html").cast("string"), cache_control=F.lit("max-age=60"), server=F.lit("a")).alias("headers"),
    )
    later = at + 300 * (1 + page % 4)
    sent = F.when(page % 5 == 0, nothing).when(page % 11 == 0, F.lit('"changed"')).when(page % 3 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    revisits = pages.select(
        (page * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), F.concat("url", F.when(page % 2 == 0, "#again").otherwise("")).alias("url"),
        later.alias("ts"), F.lit(304).alias("status"), sent.alias("etag"), F.when(page % 7 == 0, F.lit(None)).otherwise(at - 86400 + F.when(page % 13 == 0, 1).otherwise(0)).alias("last_modified"),
        pairs(date=later.cast("string"), cache_control=F.lit("max-age=120"), content_length=F.lit("0")).alias("headers"),
    )
    return responses.unionByName(revisits)
