"""Co-occurrence, affinity and recommendations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import dateadd, trunc_to
from ..functions.numeric import blended_percent, blended_score, min_max_percent, raw_affinity, round_ratio
from ..functions.text import reasoning_text
from ..session import materialize
from .sessions import GAP_MINUTES, session_minutes

ITEM = ("track_id", "track_name", "artist_name")
BLOCK_ITEMS = 1_000
TOP_N = 50
#: Items and pairs a user may have in all to be paired in the task that holds the user, and those of one task.
LIGHT, TASK_PAIRS = 20_000, 500_000


def session_items(plays: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Distinct (user, session, item) with its number of ``plays``.

    Plays are reduced to (user, minute, item) first. The session map is built
    from that same frame with all its columns in use, so both sides of the
    join read one shuffle.
    """
    per_minute = plays.groupBy("user_id", trunc_to("minute", "played_at").alias("minute"), *ITEM).agg(
        F.count("*").alias("plays")
    )
    found = session_minutes(per_minute, gap_minutes, ts="minute", plays=F.sum("plays"))
    found = found.select(F.col("user_id").alias("_user"), F.col("minute").alias("_minute"), "session_id")
    here = (F.col("user_id") == F.col("_user")) & F.col("minute").eqNullSafe(F.col("_minute"))
    return per_minute.join(found, here).groupBy("user_id", "session_id", *ITEM).agg(F.sum("plays").alias("plays"))


def basket_items(rows: DataFrame, user: str, basket: str, item: str) -> DataFrame:
    """The same shape from ready-made baskets (for example order lines)."""
    name = F.col("track_id").cast("string")
    items = rows.groupBy(F.col(user).alias("user_id"), F.col(basket).alias("session_id"), F.col(item).alias("track_id"))
    items = items.agg(F.count("*").alias("plays"))
    return items.select("user_id", "session_id", "track_id", name.alias("track_name"), name.alias("artist_name"), "plays")


def _with_blocks(items: DataFrame, block_items: int) -> DataFrame:
    """Adds ``blocks``: 1, or for a session of more items than a block ceil(items / block size).

    Only such large sessions are looked up, and there is at most one per
    ``block_items`` rows, so the table joined here is small next to the items.
    """
    session = ["user_id", "session_id"]
    large = items.groupBy(*session).agg(F.count("*").alias("_items")).filter(F.col("_items") > block_items)
    blocks = F.coalesce(F.ceil(F.col("_items") / block_items), F.lit(1)).cast("int")
    return items.join(large, session, "left").withColumn("blocks", blocks).drop("_items")


def session_pairs(items: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Pairs of tracks heard in one session, the smaller id as ``track_a``.

    A session of n items is cut into b = ceil(n / block size) blocks, and each
    pair of blocks is a join key of its own. An everyday session has one block
    and is joined as it is; one with a third of all items becomes b * b keys
    of bounded size that spread over the cluster, each item sent to b of them.
    """
    blocked = _with_blocks(items, block_items)
    block = F.pmod(F.hash(*ITEM), "blocks")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def side(tag: str, row, column) -> DataFrame:
        return blocked.select(
            "user_id",
            "session_id",
            F.col("track_id").alias(f"track_{tag}_id"),
            F.col("track_name").alias(f"track_{tag}_name"),
            F.col("artist_name").alias(f"track_{tag}_artist"),
            row.alias("_row"),
            column.alias("_column"),
        )

    a = side("a", block, F.explode(every))
    b = side("b", F.explode(every), block)
    keys = ["user_id", "session_id", "_row", "_column"]
    pairs = a.join(b, keys).filter(F.col("track_a_id") < F.col("track_b_id"))
    return pairs.drop("_row", "_column")


def track_session_counts(items: DataFrame) -> DataFrame:
    """Sessions per user and track."""
    return items.groupBy("user_id", "track_id").agg(F.countDistinct("session_id").alias("total_sessions"))


PAIR = ("user_id", "track_a_id", "track_a_name", "track_a_artist", "track_b_id", "track_b_name", "track_b_artist")


def by_load(items: DataFrame, light: int = LIGHT) -> tuple[DataFrame, DataFrame | None, int]:
    """Items of everyday users, those of users with more than ``light`` items and pairs (None: there are none), and tasks for the former.

    A session of n items counts n * (n + 1) / 2. The number of tasks follows the
    load, so that a task has the same number of pairs at any size.
    """
    n = F.col("_n")
    per_session = items.groupBy("user_id", "session_id").agg(F.count("*").alias("_n"))
    loads = materialize(per_session.groupBy("user_id").agg(F.sum((n * (n + 1) / 2).cast("long")).alias("_load")), "loads")
    heavy = F.col("_load") > light
    total, many = loads.agg(F.sum(F.when(~heavy, F.col("_load"))), F.count_if(heavy)).first()
    parts = max(math.ceil((total or 0) / TASK_PAIRS), items.sparkSession.sparkContext.defaultParallelism)
    if not many:
        return items, None, parts
    users = loads.filter(heavy).select("user_id")
    return items.join(users, "user_id", "left_anti"), items.join(users, "user_id", "left_semi"), parts


def pairs_in_place(items: DataFrame, parts: int, by: tuple[str, ...] = PAIR, min_sessions: int = 1) -> DataFrame:
    """``sessions_together`` of each pair of :func:`session_pairs`, and both totals of sessions, for users of a bounded load.

    The items are shuffled once, by user. Totals, sessions, pairs and their
    counts then follow in the task of the user: no pair is ever moved. Columns
    of ``items`` that start with ``_`` belong to the item; they come along for
    either track, with ``_a`` and ``_b`` behind their names.
    """
    known = items.filter(F.col("user_id").isNotNull() & F.col("session_id").isNotNull() & F.col("track_id").isNotNull())
    of_track = Window.partitionBy("user_id", "track_id")
    placed = known.repartition(parts, "user_id").withColumn("_total", F.size(F.collect_set("session_id").over(of_track)).cast("long"))
    if min_sessions > 1:
        # A track heard in fewer sessions cannot be part of such a pair.
        placed = placed.filter(F.col("_total") >= min_sessions)
    carried = [c for c in placed.columns if c.startswith("_")]
    heard = placed.groupBy("user_id", "session_id").agg(F.sort_array(F.collect_list(F.struct(*ITEM, *carried))).alias("_heard"))
    each = heard.select("user_id", "_heard", F.posexplode("_heard").alias("_at", "_a"))
    later = F.slice("_heard", F.col("_at") + 2, F.size("_heard"))
    pairs = each.select("user_id", "_a", F.explode(later).alias("_b")).filter(F.col("_a.track_id") < F.col("_b.track_id"))
    fields = {f"track_{t}_{n}": F.col(f"_{t}.{c}") for t in "ab" for n, c in zip(("id", "name", "artist"), ITEM)}
    values = {f"{c}_{t}": F.col(f"_{t}.{c}") for t in "ab" for c in carried}
    named = pairs.select("user_id", *[c.alias(n) for n, c in {**fields, **values}.items() if n in by or n in values])
    counted = named.groupBy(*by).agg(F.count("*").alias("sessions_together"), *[F.max(n).alias(n) for n in values])
    return counted.filter(F.col("sessions_together") >= min_sessions) if min_sessions > 1 else counted


def pair_counts(items: DataFrame, by: tuple[str, ...] = PAIR, light: int = LIGHT) -> DataFrame:
    """``sessions_together``: the rows of :func:`session_pairs` for each value of ``by``, which has the user and both track ids."""
    everyday, heavy, parts = by_load(items, light)
    counts = pairs_in_place(everyday, parts, by).select(*by, "sessions_together")
    if heavy is None:
        return counts
    return counts.unionByName(session_pairs(heavy).groupBy(*by).agg(F.count("*").alias("sessions_together")))


def _mirrored(pairs: DataFrame) -> DataFrame:
    """Every pair and its reverse."""
    swap = {f"track_a_{p}": f"track_b_{p}" for p in ("id", "name", "artist")} | {"_total_a": "_total_b"}
    swap |= {v: k for k, v in swap.items()}
    other = F.struct(*[F.col(swap.get(c, c)).alias(c) for c in pairs.columns])
    return pairs.select(F.inline(F.array(F.struct(*pairs.columns), other)))


def score_pairs(items: DataFrame, min_sessions: int = 1, symmetric: bool = False, light: int = LIGHT) -> DataFrame:
    """Sessions shared by each pair and the share of track a's sessions."""
    everyday, heavy, parts = by_load(items, light)
    pairs = pairs_in_place(everyday, parts, min_sessions=min_sessions)
    pairs = (_mirrored(pairs) if symmetric else pairs).withColumnRenamed("_total_a", "track_a_total_sessions")
    score = round_ratio("sessions_together", "track_a_total_sessions").alias("cooccurrence_score")
    scored = pairs.select(*PAIR, "sessions_together", "track_a_total_sessions", score)
    return scored if heavy is None else scored.unionByName(_score_shuffled(heavy, min_sessions, symmetric))


def _score_shuffled(items: DataFrame, min_sessions: int = 1, symmetric: bool = False) -> DataFrame:
    """:func:`score_pairs` for users of any size: sessions and then pairs are spread over the cluster."""
    totals = track_session_counts(items)
    if min_sessions > 1:
        # A track heard in fewer sessions cannot be part of such a pair.
        often = totals.filter(F.col("total_sessions") >= min_sessions)
        items = items.join(often, ["user_id", "track_id"], "left_semi")
    pairs = session_pairs(items).groupBy(*PAIR).agg(F.count("*").alias("sessions_together"))
    if min_sessions > 1:
        pairs = pairs.filter(F.col("sessions_together") >= min_sessions)
    if symmetric:
        swap = {f"track_a_{p}": f"track_b_{p}" for p in ("id", "name", "artist")}
        swap |= {v: k for k, v in swap.items()}
        mirrored = pairs.select(*[F.col(c).alias(swap.get(c, c)) for c in pairs.columns])
        pairs = pairs.unionByName(mirrored)
    totals = totals.select(
        "user_id", F.col("track_id").alias("track_a_id"), F.col("total_sessions").alias("track_a_total_sessions")
    )
    return pairs.join(totals, ["user_id", "track_a_id"]).select(
        *PAIR,
        "sessions_together",
        "track_a_total_sessions",
        round_ratio("sessions_together", "track_a_total_sessions").alias("cooccurrence_score"),
    )


def track_cooccurrence(
    silver: DataFrame,
    gap_minutes: int = GAP_MINUTES,
    min_sessions: int = 1,
    user_id: str | None = None,
    symmetric: bool = False,
    top_per_track: int | None = None,
) -> DataFrame:
    """Track pairs per user with the sessions they share.

    The items of all sessions are written once and read three times: as either
    half of a pair, and for the totals.

    ``top_per_track`` keeps the best ranked partners of each track (ties share
    a rank) and adds the ``rank`` column; :func:`top_pairs.top_partners` then
    does without most of the other pairs.
    """
    from .top_pairs import top_partners  # built on this module

    if user_id is not None:
        silver = silver.filter(F.col("user_id") == user_id)
    items = materialize(session_items(silver, gap_minutes), "items")
    if top_per_track is not None and not symmetric:
        return top_partners(items, top_per_track, min_sessions)
    scored = score_pairs(items, min_sessions, symmetric)
    if top_per_track is None:
        return scored
    w = Window.partitionBy("user_id", "track_a_id").orderBy(F.col("sessions_together").desc())
    return scored.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= top_per_track)


def artist_scores(
    silver: DataFrame,
    as_of: str | None = None,
    recent_days: int = 7,
    recent_weight: int = 2,
    w_plays: float = 0.6,
    w_tracks: float = 0.4,
    normalize: str = "global",
) -> DataFrame:
    """How much each user likes each artist, 0..100; recent plays count more.

    Scores are scaled over all users (``global``) or within each user
    (``per_user``), and are null when all raw scores are equal.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    recent = F.col("played_at") >= dateadd("day", -recent_days, now.cast("timestamp_ntz"))
    per_artist = (
        silver.groupBy("user_id", "artist_name")
        .agg(
            F.count("*").alias("total_plays"),
            F.countDistinct("track_id").alias("unique_tracks"),
            F.sum(F.when(recent, recent_weight).otherwise(1)).alias("weighted_plays"),
        )
        .withColumn("_raw", raw_affinity("weighted_plays", "unique_tracks", w_plays, w_tracks))
    )
    # total_plays is carried along so that the span and the rows share one shuffle.
    span = [F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi"), F.sum("total_plays").alias("_n")]
    if normalize == "global":
        overall = per_artist.select(F.struct(*span)).scalar()
        scored, lo, hi = per_artist, overall.getField("_lo"), overall.getField("_hi")
    elif normalize == "per_user":
        scored, lo, hi = per_artist.join(per_artist.groupBy("user_id").agg(*span), "user_id"), F.col("_lo"), F.col("_hi")
    else:
        raise ValueError("normalize must be 'global' or 'per_user'")
    return scored.select(
        "user_id",
        "artist_name",
        "total_plays",
        "unique_tracks",
        "weighted_plays",
        min_max_percent(F.col("_raw"), lo, hi).alias("affinity_score"),
    )


def artist_affinity(
    silver: DataFrame, as_of: str | None = None, top_n: int = TOP_N, user_id: str | None = None, **scoring
) -> DataFrame:
    """The ``top_n`` artists of each user by :func:`artist_scores`, ranked."""
    if user_id is not None:
        silver = silver.filter(F.col("user_id") == user_id)
    scored = artist_scores(silver, as_of, **scoring)
    w = Window.partitionBy("user_id").orderBy(F.col("affinity_score").desc_nulls_first(), "artist_name")
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= top_n)


def artist_affinity_tiered(silver: DataFrame, as_of: str | None = None, top_n: int = TOP_N) -> DataFrame:
    """Variant: weights 2.0 / 1.5 / 1.0 by age in days, score as percent of the user's best artist, ties share a rank."""
    today = F.to_date(F.current_timestamp() if as_of is None else F.lit(as_of))
    weight = (
        F.when(F.col("played_at") >= F.date_sub(today, 7), F.lit(2.0))
        .when(F.col("played_at") >= F.date_sub(today, 30), F.lit(1.5))
        .otherwise(F.lit(1.0))
    )
    per_artist = silver.groupBy("user_id", "artist_name").agg(
        F.count("*").alias("total_plays"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.max("played_at").alias("last_played_at"),
        F.sum(weight).alias("_weighted"),
    )
    best = per_artist.groupBy("user_id").agg(F.max("_weighted").alias("_best"))
    w = Window.partitionBy("user_id").orderBy(F.col("_weighted").desc())
    return (
        per_artist.withColumn("affinity_rank", F.rank().over(w).cast("long"))
        .filter(F.col("affinity_rank") <= top_n)
        .join(best, "user_id")
        .select(
            "user_id",
            "artist_name",
            "total_plays",
            "unique_tracks",
            "last_played_at",
            F.round(F.col("_weighted") / F.col("_best") * 100, 2).alias("affinity_score"),
            "affinity_rank",
        )
    )


def score_candidates(cooc: DataFrame, affinity: DataFrame, w_co: float = 0.7, w_aff: float = 0.3) -> DataFrame:
    """Pairs with the affinity of the second track's artist (0 if unknown) and the blended score."""
    liked = affinity.select("user_id", F.col("artist_name").alias("track_b_artist"), "affinity_score")
    joined = cooc.join(liked, ["user_id", "track_b_artist"], "left")
    score = F.coalesce(F.col("affinity_score"), F.lit(0.0))
    return joined.select(
        *[c for c in cooc.columns],
        score.alias("artist_affinity_score"),
        blended_score("cooccurrence_score", score, w_co, w_aff).alias("recommendation_score"),
    )


def scored_pairs(
    items: DataFrame, affinity: DataFrame, w_co: float = 0.7, w_aff: float = 0.3, light: int = LIGHT
) -> DataFrame:
    """The rows of :func:`score_candidates` from the items of sessions; everyday users' pairs bring the affinity along."""
    everyday, heavy, parts = by_load(items, light)
    scored = scored_in_place(everyday, affinity, parts, w_co, w_aff)
    if heavy is None:
        return scored
    return scored.unionByName(score_candidates(_score_shuffled(heavy), affinity, w_co, w_aff))


def scored_in_place(items: DataFrame, affinity: DataFrame, parts: int, w_co: float = 0.7, w_aff: float = 0.3) -> DataFrame:
    """:func:`scored_pairs` for users of a bounded load: the affinity goes to the items, which are fewer than the pairs."""
    liked = affinity.select("user_id", "artist_name", F.col("affinity_score").alias("_liked"))
    pairs = pairs_in_place(items.join(liked, ["user_id", "artist_name"], "left"), parts)
    score = F.coalesce("_liked_b", F.lit(0.0))
    co = round_ratio("sessions_together", "_total_a")
    return pairs.select(
        *PAIR,
        "sessions_together",
        F.col("_total_a").alias("track_a_total_sessions"),
        co.alias("cooccurrence_score"),
        score.alias("artist_affinity_score"),
        blended_score(co, score, w_co, w_aff).alias("recommendation_score"),
    )


def _played(silver: DataFrame) -> DataFrame:
    return silver.select("user_id", F.col("track_id").alias("track_b_id")).distinct()


def track_recommendations(
    cooc: DataFrame,
    affinity: DataFrame,
    w_co: float = 0.7,
    w_aff: float = 0.3,
    top_n: int = TOP_N,
    exclude_played: DataFrame | None = None,
) -> DataFrame:
    """Best ``top_n`` candidates per user.

    Tracks the user has already played stay in, unless the plays are passed as
    ``exclude_played``.
    """
    scored = score_candidates(cooc, affinity, w_co, w_aff)
    if exclude_played is not None:
        scored = scored.join(_played(exclude_played), ["user_id", "track_b_id"], "left_anti")
    return best_per_user(scored, top_n)


def best_per_user(scored: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The ``top_n`` scored pairs of each user as recommendations."""
    ties = ["track_a_id", "track_b_id", "track_a_name", "track_b_name", "track_a_artist", "track_b_artist"]
    w = Window.partitionBy("user_id").orderBy(F.col("recommendation_score").desc(), *ties)
    return (
        scored.withColumn("rank", F.row_number().over(w).cast("long"))
        .filter(F.col("rank") <= top_n)
        .select(
            "user_id",
            F.col("track_b_id").alias("recommended_track_id"),
            F.col("track_b_name").alias("recommended_track_name"),
            F.col("track_b_artist").alias("recommended_artist"),
            "cooccurrence_score",
            "artist_affinity_score",
            "recommendation_score",
            F.col("track_a_name").alias("based_on_track"),
            F.col("track_a_artist").alias("based_on_artist"),
            "rank",
        )
    )


def recommend_for_track(
    cooc: DataFrame, affinity: DataFrame, track_id: str, user_id: str | None = None, limit: int = 10
) -> DataFrame:
    """Recommendations for one source track; no rows when it is unknown."""
    if not 1 <= limit <= 50:
        raise ValueError("limit must be between 1 and 50")
    seeds = cooc.filter(F.col("track_a_id") == track_id)
    if user_id is not None:
        seeds = seeds.filter(F.col("user_id") == user_id)
    return best_for_track(score_candidates(seeds, affinity), track_id, user_id, limit)


def store_scored(scored: DataFrame, path: str, parts: int = 16) -> None:
    """Scored pairs as files for lookups: folders by a hash of the user, sorted by source track inside.

    A lookup's filter on the track then skips most row groups by their
    statistics, one on the user all other folders. Large folders are split.
    """
    placed = scored.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int"))
    spread = placed.hint("rebalance", "part").sortWithinPartitions("part", "track_a_id")
    spread.write.mode("overwrite").partitionBy("part").parquet(path)


def stored_scored(spark: SparkSession, path: str, user_id: str | None = None, parts: int = 16) -> DataFrame:
    """What :func:`store_scored` wrote, of one user if given."""
    rows = spark.read.parquet(path)
    if user_id is not None:
        folder = F.pmod(F.xxhash64(F.lit(user_id)), F.lit(parts)).cast("int")
        rows = rows.filter((F.col("part") == folder) & (F.col("user_id") == user_id))
    return rows.drop("part")


#: What a lookup says of a track that has no recommendations.
UNKNOWN = "Unknown"
NO_HISTORY = "No recommendations available yet. This track needs more listening history."


def best_for_track(scored: DataFrame, track_id: str, user_id: str | None = None, limit: int = 10) -> DataFrame:
    """The first ``limit`` scored pairs of a source track, with their reasons."""
    if not 1 <= limit <= 50:
        raise ValueError("limit must be between 1 and 50")
    scored = scored.filter(F.col("track_a_id") == track_id)
    if user_id is not None:
        scored = scored.filter(F.col("user_id") == user_id)
    reason = reasoning_text("cooccurrence_score", "artist_affinity_score", "sessions_together")
    order = [F.col("recommendation_score").desc(), "user_id", "track_b_id", "track_b_name", "track_b_artist"]
    return scored.select("*", reason.alias("reasoning")).orderBy(*order).limit(limit)


def track_answer(scored: DataFrame, track_id: str, user_id: str | None = None, limit: int = 10) -> DataFrame:
    """One row: the track, its recommendations in order, and a message where it has none."""
    order = F.struct((-F.col("recommendation_score")).alias("_rank"), "user_id", "track_b_id", "track_b_name", "cooccurrence_score", "reasoning")
    best = best_for_track(scored, track_id, user_id, limit)
    return best.agg(
        F.coalesce(F.min("track_a_name"), F.lit(UNKNOWN)).alias("track_name"),
        F.coalesce(F.min("track_a_artist"), F.lit(UNKNOWN)).alias("artist_name"),
        F.transform(F.array_sort(F.collect_list(order)), lambda r: r.dropFields("_rank")).alias("recommendations"),
        F.count("*").alias("total_recommendations"),
    ).select(
        F.lit(track_id).alias("track_id"), "*", F.when(F.col("total_recommendations") == 0, NO_HISTORY).alias("message")
    )


def recommend_batch_response(cooc: DataFrame, affinity: DataFrame | None = None, limit: int = 10) -> DataFrame:
    """The answer for every (user, track) at once: one row with an array of recommendations.

    The lookup table a serving layer reads; each array holds at most ``limit`` entries.
    """
    scored = cooc if affinity is None else score_candidates(cooc, affinity)
    source = ["user_id", "track_a_id"]
    order = [F.col("recommendation_score").desc(), "track_b_id", "track_b_name", "track_b_artist", "track_a_name"]
    w = Window.partitionBy(*source).orderBy(*order)
    best = scored.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
    entry = F.struct(
        F.col("_rn").alias("position"),
        F.col("track_b_id").alias("track_id"),
        F.col("track_b_name").alias("track_name"),
        F.col("track_b_artist").alias("artist_name"),
        "cooccurrence_score",
        "sessions_together",
        "artist_affinity_score",
        "recommendation_score",
        reasoning_text("cooccurrence_score", "artist_affinity_score", "sessions_together").alias("reasoning"),
    )
    return best.groupBy(*source).agg(
        F.min("track_a_name").alias("track_name"),
        F.min("track_a_artist").alias("artist_name"),
        F.array_sort(F.collect_list(entry)).alias("recommendations"),
        F.count("*").alias("total_recommendations"),
    )


def latest_row(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    """The newest row."""
    return df.orderBy(F.col(ts).desc(), *ties).limit(1)


def recommend_for_current(current: DataFrame, cooc: DataFrame, affinity: DataFrame | None = None, limit: int = 10) -> DataFrame:
    """Recommendations for the track playing now; without ``affinity``, ``cooc`` are pairs that are scored already."""
    # A single row by construction, so it may be broadcast.
    now = latest_row(current, "detected_at", "user_id", "track_id").select("user_id", F.col("track_id").alias("track_a_id"))
    seeds = cooc.join(F.broadcast(now), ["user_id", "track_a_id"], "left_semi")
    order = [F.col("recommendation_score").desc(), "track_b_id", "track_b_name", "track_b_artist"]
    scored = seeds if affinity is None else score_candidates(seeds, affinity)
    return scored.orderBy(*order).limit(limit)


def recommendation_coverage(cooc: DataFrame, silver: DataFrame) -> DataFrame:
    """Per user: co-occurring tracks, how many were played before, how many are new."""
    tracks = cooc.select("user_id", "track_b_id").distinct()
    heard = _played(silver).withColumn("_heard", F.col("track_b_id"))
    return (
        tracks.join(heard, ["user_id", "track_b_id"], "left")
        .groupBy("user_id")
        .agg(
            F.count("track_b_id").alias("total_cooccurrence_tracks"),
            F.count("_heard").alias("tracks_already_played"),
        )
        .withColumn(
            "new_recommendations", F.col("total_cooccurrence_tracks") - F.col("tracks_already_played")
        )
    )


def seeded_recommendations(
    silver: DataFrame,
    cooc: DataFrame,
    affinity: DataFrame,
    min_plays: int = 3,
    top_n: int = TOP_N,
    exclude_played: DataFrame | None = None,
) -> DataFrame:
    """Variant: one row per candidate, scored over all the tracks the user plays often.

    The mean co-occurrence over those seed tracks is blended with the artist's
    affinity; ties share a rank.
    """
    seeds = (
        silver.groupBy("user_id", "track_id", "track_name", "artist_name")
        .agg(F.count("*").alias("_plays"))
        .filter(F.col("_plays") >= min_plays)
        .select("user_id", F.col("track_id").alias("track_a_id"))
    )
    pairs = cooc.join(seeds, ["user_id", "track_a_id"], "left_semi")
    if exclude_played is not None:
        pairs = pairs.join(_played(exclude_played), ["user_id", "track_b_id"], "left_anti")
    candidates = pairs.groupBy("user_id", "track_b_id", "track_b_name", "track_b_artist").agg(
        F.max("cooccurrence_score").alias("_best"),
        F.round(F.avg(F.col("cooccurrence_score").cast("decimal(9,3)")), 6).cast("decimal(9,6)").alias("_mean"),
        F.countDistinct("track_a_id").alias("num_source_tracks"),
    )
    liked = affinity.select("user_id", F.col("artist_name").alias("track_b_artist"), "affinity_score")
    scored = candidates.join(liked, ["user_id", "track_b_artist"], "left").withColumn(
        "recommendation_score", blended_percent("_mean", "affinity_score")
    )
    # The wording shown to listeners.
    reason = (
        F.when(F.col("affinity_score") >= 70, "High affinity artist + Often played together")
        .when(F.col("affinity_score") >= 40, "Moderate affinity artist + Often played together")
        .when(F.col("num_source_tracks") >= 3, "Frequently co-occurs with multiple tracks you love")
        .otherwise("Often played together with tracks you enjoy")
    )
    w = Window.partitionBy("user_id").orderBy(F.col("recommendation_score").desc())
    return (
        scored.filter(F.col("recommendation_score") > 0)
        .withColumn("recommendation_rank", F.rank().over(w).cast("long"))
        .filter(F.col("recommendation_rank") <= top_n)
        .select(
            "user_id",
            F.col("track_b_id").alias("track_id"),
            F.col("track_b_name").alias("track_name"),
            F.col("track_b_artist").alias("artist_name"),
            "recommendation_score",
            reason.alias("recommendation_reason"),
            F.round("_best", 2).alias("cooccurrence_score"),
            F.round(F.coalesce("affinity_score", F.lit(0.0)), 2).alias("artist_score"),
            "num_source_tracks",
            "recommendation_rank",
        )
    )
