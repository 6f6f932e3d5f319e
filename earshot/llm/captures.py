"""A crawl made from the ``pages`` table: each page is fetched in full once and asked again later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def captures(pages: DataFrame) -> DataFrame:
    """One response and two revisits per page.

    The response's tag is the content's; of the revisits some ask with that
    tag, some with the time only, some with an old tag and some with nothing.
    """
    n = F.col("page_id")
    digest = F.md5(F.coalesce("html", F.lit("")))
    seconds = F.lit(1_700_000_000) + n * 7919 % 1_000_000
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    text = lambda c: c.cast("string")

    def record(number: int):
        later = seconds + number * 86_400 + n % 3 * 40_000
        kind = (n + number) % 5
        if number == 0:
            return F.struct(
                (n * 3).alias("record_id"), F.lit("response").alias("kind"), F.col("url"), F.timestamp_seconds(seconds).alias("fetched_at"),
                tag.alias("etag"), text(seconds - 3600).alias("last_modified"),
                F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Date"), text(seconds), F.lit("Server"), text(n % 4)).alias("headers"),
                digest.alias("digest"), F.length(F.coalesce("html", F.lit(""))).cast("long").alias("length"),
            )
        asked = F.when(kind <= 1, F.concat(F.lit("W/"), tag)).when(kind == 2, F.lit('"old"'))
        return F.struct(
            (n * 3 + number).alias("record_id"), F.lit("revisit").alias("kind"), F.col("url"), F.timestamp_seconds(later).alias("fetched_at"),
            asked.alias("etag"), F.when(kind == 3, text(seconds - 3600)).alias("last_modified"),
            F.create_map(F.lit("date"), text(later), F.lit("content-length"), F.lit("0"), F.lit("x-cache"), F.lit("HIT")).alias("headers"),
            F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("length"),
        )

    return pages.select(F.inline(F.array(record(0), record(1), record(2))))
