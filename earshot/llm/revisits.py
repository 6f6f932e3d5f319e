"""Not-modified revisits of a crawl, resolved against the latest earlier full response.

A revisit record says "as before" and carries validators and a few headers.
Its content is that of the last full response of the same canonical URL before
it, if the validators agree. Then the stored headers hold, except those that a
not-modified answer may replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

FULL, REVISIT = "response", "revisit"

#: Headers of the connection or of the content, which a not-modified answer does not replace (RFC 9110, 7.6.1 and 15.4.5).
NOT_MERGED = """
connection keep-alive proxy-authenticate proxy-authorization proxy-connection te trailer transfer-encoding upgrade
content-encoding content-length content-range content-type content-md5 digest
""".split()
#: Query parameters that say where a reader came from, not what is read.
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid|sessionid|sid)"


def canonical_url(url: Column) -> Column:
    """Scheme-free, lower-case host without www. and default port; path without closing slash; sorted query.

    Fragments and tracking parameters go, percent signs are upper case. Null
    stays null, what is no URL is only trimmed and lower-cased at its host.
    """
    text = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\d?\.|:(?:80|443)$|\.$", "")
    host = F.regexp_replace(host, r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"/index\.html?$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    pairs = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)")))
    return F.concat(host, path, F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(""))


def weak_tag(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(etag), r"^[Ww]/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored headers, with those of a not-modified answer in their place where that is allowed; names in lower case."""
    none = F.lit(None).cast("map<string,string>")
    old = F.coalesce(stored, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    new = F.map_filter(F.coalesce(fresh, none, old), lambda k, _: ~k.isin(NOT_MERGED))
    new = F.when(fresh.isNull(), F.map_filter(old, lambda k, _: F.lit(False))).otherwise(new)
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(new), k), F.lit(False))), new)


def low_names(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ only in case the first in order counts."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    firsts = F.filter(F.transform(entries, lambda e, i: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), i.alias("i"))), lambda e: F.array_position(names, e["key"]) == e["i"] + 1)
    return F.map_from_entries(F.transform(firsts, lambda e: F.struct(e["key"], e["value"])))


def as_of(rows: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``rows`` with the latest non-null ``value`` of earlier rows of the same key, as ``name``.

    Rows are range-partitioned by key and order, so a key with a third of all
    rows lies in many partitions. Each partition looks back inside itself; the
    last value that each hands on is one row per key and partition.
    """
    dealt = rows.withColumn("_value", value).repartitionByRange(F.col(key), *map(F.col, order))
    placed = materialize(dealt.withColumn("_part", F.spark_partition_id()), "as-of")
    inside = Window.partitionBy(key, "_part").orderBy(*order)
    near = F.last("_value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    place = F.struct(*[F.col(c) for c in order])
    edges = placed.groupBy(key, "_part").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), place)).alias("e"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(F.col(key).alias("_k"), F.col("_part").alias("_p"), F.last("e", ignorenulls=True).over(before).alias("_carried"))
    looked = placed.withColumn("_near", near)
    joined = looked.join(carried, looked[key].eqNullSafe(carried["_k"]) & (looked["_part"] == carried["_p"]))
    return joined.withColumn(name, F.coalesce("_near", "_carried")).drop("_near", "_carried", "_k", "_p", "_part", "_value")


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit with the response it stands for.

    ``records`` needs ``record_id, kind ('response' or 'revisit'), url,
    fetched_at, etag, last_modified, headers (map), digest, length``; bodies
    stay where they are, ``record_id`` leads to them. Returns ``record_id, url,
    fetched_at, response_id, response_at, outcome, digest, length, headers``.

    A response at the same moment is not earlier; of responses at one moment
    the largest record_id is the latest. Only that one is asked: with an entity
    tag in the revisit the tags decide (weak comparison), else the
    modification times, else there is nothing to check. ``outcome`` is
    ``resolved``, ``changed`` (a validator disagrees), ``unchecked`` (no
    validator; content is taken), ``no_response`` or ``no_url`` (null url or
    time). Only resolved and unchecked ones get content and merged headers.
    Repeated records are resolved each by itself, other kinds are ignored.
    """
    rows = records.filter(F.col("kind").isin(FULL, REVISIT)).select(
        "record_id", "kind", "url", canonical_url(F.col("url")).alias("place"), "fetched_at", "etag", "last_modified",
        low_names(F.col("headers")).alias("headers"), "digest", "length",
    )
    usable = F.col("place").isNotNull() & F.col("fetched_at").isNotNull()
    # At one moment revisits come first, so they see only what is earlier.
    moved = rows.filter(usable).withColumn("turn", F.when(F.col("kind") == REVISIT, 0).otherwise(1))
    full = F.when(
        F.col("kind") == FULL,
        F.struct(*[F.col(c) for c in ("record_id", "fetched_at", "etag", "last_modified", "headers", "digest", "length")]),
    )
    seen = as_of(moved, "place", ["fetched_at", "turn", "record_id"], full, "old").filter(F.col("kind") == REVISIT)
    by_tag = weak_tag(F.col("etag")) == F.coalesce(weak_tag(F.col("old.etag")), F.lit(""))
    by_time = F.col("last_modified") == F.col("old.last_modified")
    agrees = F.when(F.col("etag").isNotNull(), by_tag).otherwise(F.coalesce(by_time, F.lit(False)))
    outcome = (
        F.when(F.col("old").isNull(), "no_response")
        .when(F.col("etag").isNull() & F.col("last_modified").isNull(), "unchecked")
        .when(agrees, "resolved")
        .otherwise("changed")
    )
    taken = F.col("outcome").isin("resolved", "unchecked")
    found = seen.withColumn("outcome", outcome).select(
        "record_id", "url", "fetched_at",
        F.col("old.record_id").alias("response_id"),
        F.col("old.fetched_at").alias("response_at"),
        "outcome",
        F.when(taken, F.col("old.digest")).alias("digest"),
        F.when(taken, F.col("old.length")).alias("length"),
        F.when(taken, merged_headers(F.col("old.headers"), F.col("headers"))).alias("headers"),
    )
    lost = rows.filter(~usable & (F.col("kind") == REVISIT)).select("record_id", "url", "fetched_at", F.lit("no_url").alias("outcome"))
    return found.unionByName(lost, allowMissingColumns=True)


def with_bodies(resolved: DataFrame, records: DataFrame, body: str) -> DataFrame:
    """Resolved revisits with the body of their response; bodies are moved once."""
    bodies = records.filter(F.col("kind") == FULL).select(F.col("record_id").alias("response_id"), F.col(body).alias("body"))
    return resolved.filter(F.col("digest").isNotNull()).join(bodies, "response_id")
