"""URL filters: a temporal list join.

List entries are dated events: a key is added to a list, or removed from it. Events become validity
intervals, and every capture is held against the entries that were active when it was fetched. Keys
are domains (a host and all its parent domains are looked up) or URL prefixes (host and leading path
segments are looked up, as many as the longest key has). Keys and URLs are compared without case, and
keys without a slash or a dot at their end, before intervals are made of them. The list is broadcast only after its rows and bytes have been counted and
found small; a larger list is joined by its keys, which Spark can split where a key is frequent.

Defined results: a null or unparsable URL, or a null fetch time, matches nothing; an interval holds
its first moment and not its last; several events of a key at one moment count as the last in
alphabetical order of the action (remove after add); an addition of what is active changes nothing.
Of several active entries the longest key is reported, of those the first list by name. Repeated
captures (same id) are judged alike and returned once for each; empty tables give no rows, or no
matches. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a broadcast list may hold at most.
MOST_ROWS, MOST_CHARS = 200_000, 16_000_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)"


def intervals(events: DataFrame) -> DataFrame:
    """Events (list, key, action, at) to rows (list, key, since, until): until is null while active."""
    own = events.select("list", F.regexp_replace(F.lower("key"), r"[/.]+$", "").alias("key"), "action", "at")
    last = own.where("list is not null and key <> '' and at is not null").groupBy("list", "key", "at").agg(F.max("action").alias("action"))
    by = Window.partitionBy("list", "key").orderBy("at")
    changes = last.withColumn("before", F.lag("action").over(by)).where("before is null or before <> action")
    return changes.withColumn("until", F.lead("at").over(by)).where("action = 'add'").select("list", "key", F.col("at").alias("since"), "until")


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def keys_of(url: Column, depth: int) -> Column:
    """All keys that an entry for this URL could have: its domains, and its host with up to `depth` leading path segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    parts = F.slice(F.filter(F.split(F.lower(F.regexp_extract(url, PATH, 1)), "/"), lambda p: p != ""), 1, max(depth, 1))
    parts = F.when(F.lit(depth > 0), parts).otherwise(F.slice(parts, 1, 0))
    prefixes = F.transform(parts, lambda _, i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/")))
    return F.array_distinct(F.concat(domains, prefixes))


def filtered(captures: DataFrame, events: DataFrame, capture_id: str = "page_id", url: str = "url", at: str = "fetched", most_rows: int = MOST_ROWS, most_chars: int = MOST_CHARS) -> DataFrame:
    """One row per capture: page_id, host, fetched, blocked, list, key (of the entry that blocks it)."""
    active = intervals(events)
    slashes = F.size(F.split("key", "/")) - 1
    rows, chars, depth = active.agg(F.count("*"), F.coalesce(F.sum(F.length("key") + F.length("list")), F.lit(0)), F.coalesce(F.max(slashes), F.lit(0))).first()
    active = F.broadcast(active) if rows <= most_rows and chars <= most_chars else active
    own = captures.select(F.col(capture_id).alias("page_id"), F.col(url).alias("url"), F.col(at).alias("fetched")).withColumn("row", F.monotonically_increasing_id())
    keyed = own.select("page_id", "row", "fetched", host_of(F.col("url")).alias("host"), F.explode_outer(keys_of(F.col("url"), depth)).alias("key"))
    # `row` only tells repeated captures apart within a run; it takes no part in the result
    hit = keyed.join(active, (keyed["key"] == active["key"]) & (keyed["fetched"] >= active["since"]) & (active["until"].isNull() | (keyed["fetched"] < active["until"])), "left")
    rank = F.struct((-F.length(active["key"])).alias("n"), active["list"].alias("list"), active["key"].alias("key"))
    best = hit.groupBy("page_id", "row", "host", "fetched").agg(F.min(F.when(active["key"].isNotNull(), rank)).alias("best"))
    return best.select("page_id", "host", "fetched", F.col("best").isNotNull().alias("blocked"), F.col("best.list").alias("list"), F.col("best.key").alias("key"))
