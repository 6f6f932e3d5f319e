"""The best pairs of sessions without making all pairs.

No pair shares more sessions than its rarer track has. So the pairs with the
tracks most likely to win are made first; they give a count or score that a
result must reach, and of the other tracks only those are paired that can still
reach it. Ties with the last result reach it too, so the rows are those of all
pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import blended_score, round_ratio
from ..session import materialize
from .recommend import (
    BLOCK_ITEMS, ITEM, LIGHT, PAIR, TOP_N, _with_blocks, best_per_user, by_load, pairs_in_place, scored_in_place, track_session_counts,
)

#: Tracks of a user that are paired with all others before there is a bound.
HEAD = 32


def _band(total: Column) -> Column:
    """Totals of one band differ by less than a factor of two."""
    return F.floor(F.log2(total)).cast("int")


def _counted(items: DataFrame, block_items: int) -> DataFrame:
    """Items with the sessions of their track and the blocks of their session."""
    return _with_blocks(items.join(track_session_counts(items), ["user_id", "track_id"]), block_items)


def _paired(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = (), reach: Column | None = None) -> DataFrame:
    """Sessions shared by each track of ``a`` with each of ``b`` that has a larger id, where ``reach`` holds.

    Blocks as in :func:`recommend.session_pairs`; ``keys`` are further columns
    that must agree. Columns that start with ``_`` come along for ``reach``.
    """
    block = F.pmod(F.hash(*ITEM), "blocks")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def side(rows: DataFrame, tag: str, row: Column, column: Column) -> DataFrame:
        named = [F.col("track_id").alias(f"track_{tag}_id"), F.col("track_name").alias(f"track_{tag}_name"), F.col("artist_name").alias(f"track_{tag}_artist")]
        carried = [F.col(c).alias(f"{c}_{tag}") for c in rows.columns if c.startswith("_") and c not in keys]
        total = F.col("total_sessions").alias(f"_total_{tag}")
        return rows.select("user_id", "session_id", *keys, *named, total, *carried, row.alias("_row"), column.alias("_column"))

    left, right = side(a, "a", block, F.explode(every)), side(b, "b", F.explode(every), block)
    joined = left.join(right, ["user_id", "session_id", *keys, "_row", "_column"]).filter(F.col("track_a_id") < F.col("track_b_id"))
    if reach is not None:
        joined = joined.filter(reach)
    return joined.groupBy(*PAIR).agg(F.count("*").alias("sessions_together"), F.max("_total_a").alias("track_a_total_sessions"))


def _head(items: DataFrame, order: list[Column], size: int) -> DataFrame:
    """The items, with ``_head`` true for those of the first ``size`` tracks of each user."""
    tracks = items.select("user_id", *ITEM, *[c for c in items.columns if c.startswith("_")], "total_sessions").distinct()
    first = Window.partitionBy("user_id").orderBy(*order, *ITEM)
    head = tracks.withColumn("_turn", F.row_number().over(first)).filter(F.col("_turn") <= size)
    named = [F.col(c).alias(f"_{c}") for c in ("user_id", *ITEM)]
    same = F.col("user_id").eqNullSafe(F.col("_user_id"))
    for c in ITEM:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    marked = items.join(head.select(*named, F.lit(True).alias("_head")), same, "left")
    return marked.withColumn("_head", F.coalesce("_head", F.lit(False))).drop("_user_id", *[f"_{c}" for c in ITEM])


def _ranked(pairs: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("user_id", "track_a_id").orderBy(F.col("sessions_together").desc())
    score = round_ratio("sessions_together", "track_a_total_sessions").alias("cooccurrence_score")
    ranked = pairs.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= top)
    return ranked.select(*PAIR, "sessions_together", "track_a_total_sessions", score, "rank")


def top_partners(
    items: DataFrame, top: int, min_sessions: int = 1, head: int = HEAD, block_items: int = BLOCK_ITEMS, light: int = LIGHT
) -> DataFrame:
    """Pairs whose ``track_b`` is among the best ``top`` partners of ``track_a`` by shared sessions; ties share a rank.

    ``items`` as from :func:`recommend.session_items`, read several times. A
    user's commonest tracks are paired first; then a track meets another only
    if that has as many sessions as the track's best ``top`` partners so far
    share with it. Totals are banded by powers of two and the band is a join
    key, so that the others are not made and then thrown away. Pairs of users
    with at most ``light`` items and pairs are all made, where the user is.
    """
    everyday, heavy, parts = by_load(items, light)
    near = _ranked(pairs_in_place(everyday, parts, min_sessions=min_sessions).withColumnRenamed("_total_a", "track_a_total_sessions"), top)
    return near if heavy is None else near.unionByName(_bounded_partners(heavy, top, min_sessions, head, block_items))


def _bounded_partners(items: DataFrame, top: int, min_sessions: int, head: int, block_items: int) -> DataFrame:
    counted = _counted(items, block_items)
    marked = materialize(_head(counted, [F.col("total_sessions").desc()], head), "marked")
    rest = marked.filter(~F.col("_head"))
    first = materialize(_paired(marked, marked.filter("_head")), "pairs")
    best = Window.partitionBy("user_id", "track_a_id").orderBy(F.col("sessions_together").desc())
    least = (
        first.withColumn("_turn", F.row_number().over(best))
        .filter(F.col("_turn") == top)
        .select("user_id", F.col("track_a_id").alias("track_id"), F.greatest("sessions_together", F.lit(min_sessions)).alias("_least"))
    )
    most = rest.groupBy("user_id").agg(F.max("total_sessions").alias("_most"))
    asking = (
        marked.drop("_head")
        .join(least, ["user_id", "track_id"], "left")
        .withColumn("_least", F.coalesce("_least", F.lit(min_sessions)))
        .join(most, "user_id")
        .filter((F.col("_least") <= F.col("_most")) & (F.col("_least") <= F.col("total_sessions")))
        .withColumn("_band", F.explode(F.sequence(_band(F.col("_least")), _band(F.col("_most")))))
        .drop("_most")
    )
    answering = rest.drop("_head").withColumn("_band", _band(F.col("total_sessions")))
    second = _paired(asking, answering, ("_band",), F.col("_total_b") >= F.col("_least_a"))
    return _ranked(first.unionByName(second).filter(F.col("sessions_together") >= min_sessions), top)


def top_recommendations(
    items: DataFrame, affinity: DataFrame, w_co: float = 0.7, w_aff: float = 0.3, top_n: int = TOP_N, head: int = HEAD,
    block_items: int = BLOCK_ITEMS, light: int = LIGHT,
) -> DataFrame:
    """The rows of :func:`recommend.track_recommendations` from the items of sessions.

    Pairs with tracks of the artists a user likes best give the score of the
    user's last recommendation so far. A further track is paired only if its
    artist's affinity and the whole co-occurrence could reach that score, and
    only with tracks that have not too many sessions of their own for it. Pairs
    of users with at most ``light`` items and pairs are all made, where the user is.
    """
    everyday, heavy, parts = by_load(items, light)
    near = best_per_user(scored_in_place(everyday, affinity, parts, w_co, w_aff), top_n)
    return near if heavy is None else near.unionByName(_bounded_recommendations(heavy, affinity, w_co, w_aff, top_n, head, block_items))


def _bounded_recommendations(
    items: DataFrame, affinity: DataFrame, w_co: float, w_aff: float, top_n: int, head: int, block_items: int
) -> DataFrame:
    liked = affinity.select("user_id", "artist_name", F.col("affinity_score").alias("_liked"))
    counted = _counted(items, block_items).join(liked, ["user_id", "artist_name"], "left")
    counted = counted.withColumn("_liked", F.coalesce("_liked", F.lit(0.0)))
    marked = materialize(_head(counted, [F.col("_liked").desc(), F.col("total_sessions").desc()], head), "marked")
    by_artist = liked.select("user_id", F.col("artist_name").alias("track_b_artist"), F.col("_liked").alias("artist_affinity_score"))

    def scored(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(by_artist, ["user_id", "track_b_artist"], "left").withColumns({
            "artist_affinity_score": F.coalesce("artist_affinity_score", F.lit(0.0)),
            "cooccurrence_score": round_ratio("sessions_together", "track_a_total_sessions"),
        })
        blend = blended_score("cooccurrence_score", F.col("artist_affinity_score"), w_co, w_aff)
        return joined.withColumn("recommendation_score", blend)

    first = materialize(scored(_paired(marked, marked.filter("_head"))), "pairs")
    best = Window.partitionBy("user_id").orderBy(F.col("recommendation_score").desc())
    least = first.withColumn("_turn", F.row_number().over(best)).filter(F.col("_turn") == top_n)
    least = least.select("user_id", F.col("recommendation_score").alias("_least"))

    def possible(share: Column, liking: str, bound: str) -> Column:
        return F.coalesce(blended_score(share, F.col(liking), w_co, w_aff) >= F.col(bound), F.lit(True))

    rest = marked.filter(~F.col("_head")).drop("_head").join(least, "user_id", "left").filter(possible(F.lit(1.0), "_liked", "_least"))
    share = round_ratio(F.least("_total_a", "_total_b"), F.col("_total_a"))
    second = _paired(marked.drop("_head", "_liked"), rest, (), possible(share, "_liked_b", "_least_b"))
    return best_per_user(first.unionByName(scored(second)), top_n)
