"""Not-modified revisits of a web archive, resolved against the latest earlier full response.

An as-of join by canonical URL in steps that no hot URL can upset. Records of one URL and second are one point, with the response
that later ones may take from it. Points in order of URL and time are cut into slices of about equal number, so a URL
with any share of the captures is spread over many; a window inside (slice, URL) finds the latest response there, and for points
without one the latest of the earlier slices is carried over, from one row per URL and slice. Records without a URL or a time
meet no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

# Fixed value: header fields that a 304 answer may bring up to date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host (lower case, without `www.` and default port), path without a slash at the end, and the sorted query without
    tracking parameters. Scheme and fragment go. Null for null."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"(?s)#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref)="))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(""))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored header fields, those that a 304 may update taken from it. Names are compared in lower case."""
    updates = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(updates, k)), updates)


def lower_names(headers: Column) -> Column:
    """Header fields by lower-case name; of fields with one name the first counts, and null is no fields."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
                          lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(first)


def opaque(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def latest_before(points: DataFrame, slices: int | None = None) -> DataFrame:
    """`points` (canonical_url, captured_at, last: a struct or null; one row each) with `earlier`, the `last` of the latest earlier point
    of the URL that has one. Slices follow the size of the data unless their number is given."""
    order = ("canonical_url", "captured_at")
    ranges = points.repartitionByRange(*order) if slices is None else points.repartitionByRange(slices, *order)
    placed = stored(ranges.withColumn("slice", F.spark_partition_id()), "points")
    # Inside a slice; and from slice to slice, a row per URL and slice.
    inside = W.partitionBy("slice", "canonical_url").orderBy("captured_at").rowsBetween(W.unboundedPreceding, -1)
    here = placed.withColumn("here", F.last("last", ignorenulls=True).over(inside))
    by_slice = placed.where("last IS NOT NULL").groupBy("slice", "canonical_url").agg(F.max_by("last", "captured_at").alias("last"))
    every = placed.select("slice", "canonical_url").distinct().join(by_slice, ["slice", "canonical_url"], "left")
    before = W.partitionBy("canonical_url").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = every.withColumn("carried", F.last("last", ignorenulls=True).over(before)).where("carried IS NOT NULL").drop("last")
    return here.join(carried, ["slice", "canonical_url"], "left").select(*order, F.coalesce("here", "carried").alias("earlier"))


def resolve_revisits(records: DataFrame, slices: int | None = None) -> DataFrame:
    """One row per revisit of `records` (record_id, url, captured_at in seconds, kind `response` or `revisit`, digest, headers).

    Returns record_id, canonical_url, captured_at, response_id, response_at, status, digest, headers (merged). The response
    is the latest of the canonical URL with an earlier time; of several at that time the largest record_id. status:
    `resolved` (the entity tags agree, or where one is missing the Last-Modified fields do), `etag_mismatch`, `modified`,
    `unverifiable` (no validator on both sides) or `no_response`; digest and headers are null unless resolved.

    A null url or time has no earlier response. Records of other kinds and columns beyond those named are ignored, repeated
    revisits give a row each, and an empty table none. `slices` fixes the number of slices; else it follows the data.
    """
    slim = records.where("kind IN ('response', 'revisit')").select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("captured_at").cast("long").alias("captured_at"),
        "kind", "digest", lower_names(F.col("headers")).alias("headers"))
    slim = stored(slim, "records")
    full = F.when(F.col("kind") == "response", F.struct("captured_at", "record_id", "digest", F.map_entries("headers").alias("entries")))
    # Copies of a second are reduced in the tasks: of its responses one is taken, and all its revisits meet one point.
    known = slim.where("canonical_url IS NOT NULL AND captured_at IS NOT NULL")
    points = known.groupBy("canonical_url", "captured_at").agg(F.max(full).alias("last"))
    revisits = slim.where("kind = 'revisit'").select("record_id", "canonical_url", "captured_at", "headers")
    earlier = latest_before(points, slices).where("earlier IS NOT NULL")
    # A null in either key meets nothing, and a second with any share of the revisits can be split: points are one row each.
    joined = revisits.join(earlier, ["canonical_url", "captured_at"], "left")
    found = joined.select("record_id", "canonical_url", "captured_at", "headers", F.col("earlier").alias("r"))
    found = found.withColumn("kept", F.map_from_entries("r.entries"))

    def tag(headers: str) -> Column:
        return opaque(F.element_at(F.col(headers), "etag"))

    def modified(headers: str) -> Column:
        return F.element_at(F.col(headers), "last-modified")

    status = (F.when(F.col("r").isNull(), "no_response")
              .when(tag("headers").isNotNull() & tag("kept").isNotNull(),
                    F.when(tag("headers") == tag("kept"), "resolved").otherwise("etag_mismatch"))
              .when(modified("headers").isNotNull() & modified("kept").isNotNull(),
                    F.when(modified("headers") == modified("kept"), "resolved").otherwise("modified"))
              .otherwise("unverifiable"))
    judged = found.withColumn("status", status)
    resolved = F.col("status") == "resolved"
    return judged.select(
        "record_id", "canonical_url", "captured_at", F.col("r.record_id").alias("response_id"), F.col("r.captured_at").alias("response_at"),
        "status", F.when(resolved, F.col("r.digest")).alias("digest"),
        F.when(resolved, merged_headers(F.col("kept"), F.col("headers"))).alias("headers"))


def header_lines(headers: Column) -> Column:
    """`name: value` lines by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")


# Seconds after a page's first response at which it is fetched anew, each time with another content.
VERSIONS = (0, 40_000, 130_000)


def capture_log(pages: DataFrame) -> DataFrame:
    """An archive derived from `pages` (page_id, url, html): one to three full responses of every page, and 304 answers between
    them, after them, and for some pages before the first, under another spelling of the URL. Tags and dates stem from the content of the
    time; some answers carry stale or no validators, and all carry fields that a 304 may not change."""
    page = pages.select(F.col("page_id").cast("long").alias("p"), "url", F.coalesce("html", F.lit("")).alias("html"))

    def versioned(df: DataFrame) -> DataFrame:
        """With digest, tag and day of version k."""
        content = F.when(F.col("k") == 0, F.col("html")).otherwise(F.concat(F.col("html"), F.lit("#"), F.col("k").cast("string")))
        return df.withColumn("digest", F.sha2(F.encode(content, "UTF-8"), 256)).withColumns({
            "tag": F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"')),
            "day": F.concat(F.lit("day-"), F.expr("p div 1440 + k").cast("string"))})

    def fields(**columns: Column) -> Column:
        every = F.create_map(*(x for name, c in columns.items() for x in (F.lit(name.replace("_", "-")), c)))
        return F.map_filter(every, lambda k, v: v.isNotNull())

    fetched = versioned(page.withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("p") % len(VERSIONS)).cast("int")))))
    at = F.col("p") * 60 + F.get(F.array(*map(F.lit, VERSIONS)), F.col("k"))
    response = fetched.select(
        (F.col("p") * 10 + F.col("k")).alias("record_id"), "url", at.alias("captured_at"), F.lit("response").alias("kind"), "digest",
        fields(Date=at.cast("string"), ETag=F.when(F.expr("p % 4 <> 3"), F.col("tag")), Last_Modified=F.when(F.expr("p % 6 <> 5"), F.col("day")),
               Cache_Control=F.lit("max-age=60"), Content_Type=F.lit("text/html"), Server=F.lit("origin")).alias("headers"))
    # (number, seconds after the first response, version of the time): after all, between, and before any.
    visit = F.filter(F.array(
        F.struct(F.lit(5).alias("n"), (86_400 * (F.col("p") % 3 + 1)).alias("after"), (F.col("p") % 3).cast("int").alias("k")),
        F.when(F.expr("p % 3 > 0"), F.struct(F.lit(6).alias("n"), F.lit(60_000).cast("long").alias("after"), F.lit(1).alias("k"))),
        F.when(F.expr("p % 11 = 0"), F.struct(F.lit(7).alias("n"), F.lit(-30).cast("long").alias("after"), F.lit(0).alias("k"))),
    ), lambda v: v.isNotNull())
    visited = versioned(page.withColumn("visit", F.explode(visit)).select("p", "url", "html", "visit.*"))
    again = F.col("p") * 60 + F.col("after")
    revisit = visited.select(
        (F.col("p") * 10 + F.col("n")).alias("record_id"), F.when(F.contains("url", F.lit("#")), F.col("url")).otherwise(F.concat("url", F.lit("#again"))).alias("url"),
        again.alias("captured_at"), F.lit("revisit").alias("kind"), F.lit(None).cast("string").alias("digest"),
        fields(Date=again.cast("string"), ETag=F.when(F.expr("p % 10 = 7"), F.lit('"stale"')).when(F.expr("p % 10 < 7"), F.concat(F.lit("W/"), "tag")),
               Last_Modified=F.when(F.expr("p % 7 < 4"), F.col("day")).when(F.expr("p % 7 = 4"), F.lit("day-x")),
               Cache_Control=F.lit("max-age=120"), Server=F.lit("cache"), Set_Cookie=F.lit("a=b")).alias("headers"))
    return response.unionAll(revisit)
