"""The tables the product is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import dateadd
from ..operators import gold, recommend, session_state, sessions, top_pairs
from ..operators import silver as silver_ops
from ..session import materialize, scratch_path
from . import bridge
from .bridge import AS_OF, WIDE_GAP, with_tables
from .registry import query

PAIR_COLUMNS = """user_id, track_a_id, track_a_name, track_a_artist, track_b_id, track_b_name, track_b_artist,
sessions_together, track_a_total_sessions, cooccurrence_score"""


@query("silver_plays", with_tables("silver") + "SELECT * FROM silver")
def _silver_plays(spark, sf):
    return bridge.silver(spark, sf).drop("processed_at")


@query("silver_filter", with_tables("bronze") + """
SELECT * EXCLUDE (ts) FROM bronze
WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND duration_ms > 0 AND duration_ms < 600000""")
def _silver_filter(spark, sf):
    return silver_ops.silver_filter(bridge.bronze(spark, sf))


@query("dedup_first", with_tables("bronze") + """
SELECT user_id, track_id, played_at, min(event_id) AS event_id FROM bronze
WHERE event_id IS NOT NULL GROUP BY 1, 2, 3""")
def _dedup_first(spark, sf):
    plays = bridge.bronze(spark, sf).filter(F.col("event_id").isNotNull())
    return silver_ops.dedup_first(plays).select("user_id", "track_id", "played_at", "event_id")


@query("silver_plays_distinct", with_tables("bronze") + """
SELECT DISTINCT * EXCLUDE (ts, played_at), ts AS played_at FROM bronze
WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND duration_ms > 0 AND duration_ms < 600000""")
def _silver_plays_distinct(spark, sf):
    return silver_ops.silver_plays(bridge.bronze(spark, sf), AS_OF, distinct_rows=True).drop("processed_at")


@query("daily_user_stats", with_tables("daily") + "SELECT * FROM daily")
def _daily_user_stats(spark, sf):
    return gold.daily_user_stats(bridge.silver(spark, sf))


@query("daily_user_minutes", with_tables("daily") + """
SELECT date, user_id, total_plays, round(total_listening_time_ms / 60000.0, 6) AS minutes_listened FROM daily""")
def _daily_user_minutes(spark, sf):
    stats = gold.daily_user_stats(bridge.silver(spark, sf), with_minutes=True)
    return stats.select("date", "user_id", "total_plays", F.round("minutes_listened", 6).alias("minutes_listened"))


@query("top_tracks", with_tables("tracks") + "SELECT * FROM tracks")
def _top_tracks(spark, sf):
    return gold.top_tracks(bridge.silver(spark, sf))


@query("top_artists", with_tables("artists") + "SELECT * FROM artists")
def _top_artists(spark, sf):
    return gold.top_artists(bridge.silver(spark, sf))


@query("device_usage", with_tables("devices") + "SELECT * FROM devices")
def _device_usage(spark, sf):
    return gold.device_usage(bridge.silver(spark, sf))


@query("track_popularity", with_tables("silver") + """
SELECT track_id, track_name, artist_name, count(*) AS play_count, count(DISTINCT user_id) AS unique_listeners,
       round(avg(duration_ms), 4) AS avg_duration_ms
FROM silver GROUP BY 1, 2, 3""")
def _track_popularity(spark, sf):
    out = gold.track_popularity(bridge.silver(spark, sf))
    return out.withColumn("avg_duration_ms", F.round("avg_duration_ms", 4))


@query("sessionize", with_tables("sessioned", gap=60) + "SELECT * EXCLUDE (prev) FROM sessioned")
def _sessionize(spark, sf):
    return sessions.sessionize(bridge.silver(spark, sf)).drop("processed_at")


@query("sessionize_wide_gap", with_tables("sessioned") + "SELECT * EXCLUDE (prev) FROM sessioned")
def _sessionize_wide(spark, sf):
    return sessions.sessionize(bridge.silver(spark, sf), WIDE_GAP).drop("processed_at")


@query("incremental_sessions", with_tables("sessioned", gap=60) + """
SELECT user_id, session_id, min(played_at) AS session_start, max(played_at) AS session_end, count(*) AS plays FROM sessioned GROUP BY 1, 2""")
def _incremental_sessions(spark, sf):
    """All plays in three loads of every third day, so that the later ones fill the gaps of the earlier."""
    rows, root = bridge.stored_silver(spark, sf).select("user_id", "played_at"), scratch_path(spark, "sessions")
    for load in range(3):
        session_state.load_plays(spark, root, rows.filter(F.dayofyear("played_at") % 3 == 2 - load), load)
    return session_state.stored_sessions(spark, root)


@query("sessionize_clock_hour", with_tables("silver") + """
SELECT user_id, date_trunc('hour', played_at) AS session_id, count(*) AS plays FROM silver GROUP BY 1, 2""")
def _clock_hour(spark, sf):
    hours = sessions.clock_hour_sessions(bridge.silver(spark, sf))
    return hours.groupBy("user_id", "session_id").agg(F.count("*").alias("plays"))


@query("session_self_join", with_tables("pairs") + "SELECT * FROM pairs")
def _session_self_join(spark, sf):
    return recommend.session_pairs(bridge.stored_items(spark, sf))


@query("distinct_pairs_count", with_tables("pairs") + """
SELECT user_id, track_a_id, track_b_id, count(DISTINCT session_id) AS sessions_together FROM pairs GROUP BY 1, 2, 3""")
def _distinct_pairs_count(spark, sf):
    return recommend.pair_counts(bridge.stored_items(spark, sf), ("user_id", "track_a_id", "track_b_id"))


@query("track_cooccurrence", with_tables("cooc", gap=60) + f"SELECT {PAIR_COLUMNS} FROM cooc")
def _track_cooccurrence(spark, sf):
    return bridge.cooccurrence(spark, sf, 60)


@query("track_cooccurrence_wide_gap", with_tables("cooc") + f"SELECT {PAIR_COLUMNS} FROM cooc")
def _track_cooccurrence_wide(spark, sf):
    return bridge.cooccurrence(spark, sf)


@query("pair_total_join", with_tables("cooc") + """
SELECT user_id, track_a_id, track_b_id, sessions_together, track_a_total_sessions FROM cooc""")
def _pair_total_join(spark, sf):
    return bridge.cooccurrence(spark, sf).select(
        "user_id", "track_a_id", "track_b_id", "sessions_together", "track_a_total_sessions"
    )


@query("track_cooccurrence_symmetric", with_tables("pairs") + """
, both_ways AS (
  SELECT * FROM pairs
  UNION ALL SELECT user_id, session_id, track_b_id, track_b_name, track_b_artist, track_a_id, track_a_name, track_a_artist
  FROM pairs),
totals AS (SELECT user_id, track_id, count(DISTINCT session_id) AS total_sessions FROM sessioned GROUP BY 1, 2)
SELECT b.user_id, track_a_id, track_b_id, count(*) AS sessions_together,
       round(CAST(count(*) AS DOUBLE) / any_value(total_sessions), 3) AS cooccurrence_score
FROM both_ways b JOIN totals t ON b.user_id = t.user_id AND b.track_a_id = t.track_id GROUP BY 1, 2, 3""")
def _cooccurrence_symmetric(spark, sf):
    return bridge.cooccurrence(spark, sf, symmetric=True).select(
        "user_id", "track_a_id", "track_b_id", "sessions_together", "cooccurrence_score"
    )


@query("rank_variant", with_tables("cooc") + f"""
SELECT * FROM (SELECT {PAIR_COLUMNS},
                      rank() OVER (PARTITION BY user_id, track_a_id ORDER BY sessions_together DESC) AS rank
               FROM cooc WHERE sessions_together >= 2) WHERE rank <= 20""")
def _rank_variant(spark, sf):
    ranked = bridge.cooccurrence(spark, sf, min_sessions=2, top_per_track=20)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


@query("order_line_pairs", """
WITH items AS (SELECT DISTINCT o_custkey AS user_id, l_orderkey AS session_id, l_partkey AS track_id
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT a.user_id, a.track_id AS track_a_id, b.track_id AS track_b_id, count(*) AS sessions_together
FROM items a JOIN items b ON a.user_id = b.user_id AND a.session_id = b.session_id AND a.track_id < b.track_id
GROUP BY 1, 2, 3""")
def _order_line_pairs(spark, sf):
    orders = bridge.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = bridge.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(orders, "l_orderkey")
    items = materialize(recommend.basket_items(lines, "o_custkey", "l_orderkey", "l_partkey"), "items")
    return recommend.pair_counts(items, ("user_id", "track_a_id", "track_b_id"))


@query("conditional_weight_sum", with_tables("raw_affinity") + "SELECT user_id, artist_name, weighted_plays FROM raw_affinity")
def _conditional_weight_sum(spark, sf):
    recent = F.col("played_at") >= dateadd("day", -7, F.lit(AS_OF).cast("timestamp_ntz"))
    return bridge.silver(spark, sf).groupBy("user_id", "artist_name").agg(
        F.sum(F.when(recent, 2).otherwise(1)).alias("weighted_plays")
    )


@query("artist_affinity", with_tables("affinity") + "SELECT * FROM affinity")
def _artist_affinity(spark, sf):
    return bridge.affinity(spark, sf)


@query("min_max_normalize", with_tables("raw_affinity") + """
SELECT user_id, artist_name,
       CAST(round(CAST(round(CAST(raw - min(raw) OVER w AS DOUBLE)
            / nullif(max(raw) OVER w - min(raw) OVER w, 0), 7) AS DECIMAL(18,7)) * 100, 2) AS DOUBLE) AS affinity_score
FROM raw_affinity WINDOW w AS (PARTITION BY user_id)""")
def _min_max_normalize(spark, sf):
    scored = recommend.artist_scores(bridge.silver(spark, sf), AS_OF, normalize="per_user")
    return scored.select("user_id", "artist_name", "affinity_score")


@query("rank_top_n", with_tables("affinity") + "SELECT user_id, artist_name, rank FROM affinity WHERE rank <= 3")
def _rank_top_n(spark, sf):
    return bridge.affinity(spark, sf, top_n=3).select("user_id", "artist_name", "rank")


@query("artist_affinity_tiered", with_tables("silver") + """
, m AS (SELECT user_id, artist_name, count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks,
               max(played_at) AS last_played_at,
               sum(CASE WHEN played_at >= DATE '2024-01-24' THEN 2.0 WHEN played_at >= DATE '2024-01-01' THEN 1.5
                        ELSE 1.0 END) AS weighted
        FROM silver GROUP BY 1, 2)
SELECT * FROM (
  SELECT user_id, artist_name, total_plays, unique_tracks, last_played_at,
         round(CAST(weighted AS DOUBLE) / CAST(max(weighted) OVER (PARTITION BY user_id) AS DOUBLE) * 100, 2) AS affinity_score,
         rank() OVER (PARTITION BY user_id ORDER BY weighted DESC) AS affinity_rank
  FROM m) WHERE affinity_rank <= 50""")
def _artist_affinity_tiered(spark, sf):
    return recommend.artist_affinity_tiered(bridge.silver(spark, sf), AS_OF)


@query("affinity_left_join", with_tables("scored") + """
SELECT user_id, track_a_id, track_b_id, track_b_artist, artist_affinity_score, recommendation_score FROM scored""")
def _affinity_left_join(spark, sf):
    scored = recommend.score_candidates(*bridge.pairs_and_affinity(spark, sf))
    return scored.select(
        "user_id", "track_a_id", "track_b_id", "track_b_artist", "artist_affinity_score", "recommendation_score"
    )


@query("track_recommendations", with_tables("recs") + "SELECT * FROM recs")
def _track_recommendations(spark, sf):
    """Only the pairs that can be among a user's best are made."""
    stored = bridge.stored_silver(spark, sf)
    items = materialize(recommend.session_items(stored, WIDE_GAP), "items")
    return top_pairs.top_recommendations(items, recommend.artist_affinity(stored, bridge.AS_OF))


@query("exclude_played_anti", with_tables("scored") + """
SELECT * FROM (
  SELECT user_id, track_b_id AS recommended_track_id, recommendation_score, track_a_name AS based_on_track,
         row_number() OVER (PARTITION BY user_id ORDER BY recommendation_score DESC, track_a_id, track_b_id) AS rank
  FROM scored s
  WHERE NOT EXISTS (SELECT 1 FROM silver p WHERE p.user_id = s.user_id AND p.track_id = s.track_b_id
                    AND p.played_at >= TIMESTAMP '2024-01-24 00:00:00'))
WHERE rank <= 50""")
def _exclude_played(spark, sf):
    """Leaves out what the user has played in the last week."""
    silver, cooc, liked = bridge.model_tables(spark, sf)
    lately = silver.filter(F.col("played_at") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    recs = recommend.track_recommendations(cooc, liked, exclude_played=lately)
    return recs.select("user_id", "recommended_track_id", "recommendation_score", "based_on_track", "rank")


@query("seeded_recommendations", with_tables("cooc", "affinity") + """
, seeds AS (SELECT user_id, track_id FROM silver GROUP BY user_id, track_id, track_name, artist_name HAVING count(*) >= 3),
candidates AS (
  SELECT c.user_id, track_b_id, track_b_name, track_b_artist, max(cooccurrence_score) AS best,
         CAST(round(avg(cooccurrence_score), 6) AS DECIMAL(9,6)) AS mean, count(DISTINCT track_a_id) AS num_source_tracks
  FROM cooc c WHERE EXISTS (SELECT 1 FROM seeds s WHERE s.user_id = c.user_id AND s.track_id = c.track_a_id)
  GROUP BY 1, 2, 3, 4),
scored_candidates AS (
  SELECT c.*, a.affinity_score,
         CAST(round((mean * 0.7 + CAST(coalesce(a.affinity_score, 0) AS DECIMAL(9,2)) * 0.003) * 100, 2) AS DOUBLE) AS recommendation_score
  FROM candidates c LEFT JOIN affinity a ON c.user_id = a.user_id AND c.track_b_artist = a.artist_name)
SELECT * FROM (
  SELECT user_id, track_b_id AS track_id, track_b_name AS track_name, track_b_artist AS artist_name, recommendation_score,
         CASE WHEN affinity_score >= 70 THEN 'High affinity artist + Often played together'
              WHEN affinity_score >= 40 THEN 'Moderate affinity artist + Often played together'
              WHEN num_source_tracks >= 3 THEN 'Frequently co-occurs with multiple tracks you love'
              ELSE 'Often played together with tracks you enjoy' END AS recommendation_reason,
         round(best, 2) AS cooccurrence_score, round(coalesce(affinity_score, 0), 2) AS artist_score, num_source_tracks,
         rank() OVER (PARTITION BY user_id ORDER BY recommendation_score DESC) AS recommendation_rank
  FROM scored_candidates WHERE recommendation_score > 0)
WHERE recommendation_rank <= 50""")
def _seeded_recommendations(spark, sf):
    return recommend.seeded_recommendations(*bridge.model_tables(spark, sf))


@query("recommend_for_track", with_tables("scored") + """
SELECT user_id, track_a_id, track_b_id, cooccurrence_score, sessions_together, artist_affinity_score, recommendation_score,
       CASE WHEN cooccurrence_score >= 0.8 THEN 'Frequently' WHEN cooccurrence_score >= 0.5 THEN 'Often' ELSE 'Sometimes' END
       || ' played together (' || sessions_together || ' sessions)'
       || CASE WHEN artist_affinity_score >= 80 THEN ', artist is highly preferred'
               WHEN artist_affinity_score >= 50 THEN ', artist is well-liked' ELSE '' END AS reasoning
FROM scored WHERE track_a_id = 'track_26' ORDER BY recommendation_score DESC, user_id, track_b_id LIMIT 10""")
def _recommend_for_track(spark, sf):
    recs = recommend.best_for_track(bridge.scored(spark, sf), "track_26")
    return recs.select(
        "user_id", "track_a_id", "track_b_id", "cooccurrence_score", "sessions_together",
        "artist_affinity_score", "recommendation_score", "reasoning",
    )


@query("track_answer", with_tables("scored") + """
, asked AS (SELECT unnest(['track_26', 'track_none']) AS track_id),
best AS (SELECT *, row_number() OVER (PARTITION BY track_a_id ORDER BY recommendation_score DESC, user_id, track_b_id) AS rn
         FROM scored WHERE track_a_id IN (SELECT track_id FROM asked))
SELECT asked.track_id, coalesce(min(track_a_name), 'Unknown') AS track_name, coalesce(min(track_a_artist), 'Unknown') AS artist_name,
       coalesce(string_agg(user_id || '/' || track_b_id, '|' ORDER BY rn), '') AS recommended, count(rn) AS total_recommendations,
       CASE WHEN count(rn) = 0 THEN 'No recommendations available yet. This track needs more listening history.' END AS message
FROM asked LEFT JOIN best ON track_a_id = track_id AND rn <= 10 GROUP BY 1""")
def _track_answer(spark, sf):
    """The answers for a track that has recommendations and for one that nobody knows."""
    scored = bridge.scored(spark, sf)
    answers = recommend.track_answer(scored, "track_26").unionByName(recommend.track_answer(scored, "track_none"))
    shown = F.array_join(F.transform("recommendations", lambda r: F.concat_ws("/", r["user_id"], r["track_b_id"])), "|")
    return answers.withColumn("recommended", shown).drop("recommendations")


@query("recommend_batch_response", with_tables("scored") + """
SELECT user_id, track_a_id, min(track_a_name) AS track_name, min(track_a_artist) AS artist_name,
       string_agg(track_b_id || ':' || CAST(recommendation_score AS DECIMAL(9,1)), '|'
                  ORDER BY recommendation_score DESC, track_b_id) AS recommended,
       count(*) AS total_recommendations
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, track_a_id
                                   ORDER BY recommendation_score DESC, track_b_id) AS rn FROM scored)
WHERE rn <= 10 GROUP BY 1, 2""")
def _recommend_batch(spark, sf):
    answers = recommend.recommend_batch_response(bridge.scored(spark, sf))
    shown = F.transform(
        "recommendations",
        lambda r: F.concat_ws(":", r["track_id"], r["recommendation_score"].cast("decimal(9,1)").cast("string")),
    )
    return answers.select(
        "user_id", "track_a_id", "track_name", "artist_name",
        F.array_join(shown, "|").alias("recommended"), "total_recommendations",
    )


_NOW = """
, now AS (SELECT user_id, track_id FROM playing ORDER BY detected_at DESC, user_id, track_id LIMIT 1)
SELECT s.user_id, s.track_a_id, track_b_id, cooccurrence_score, artist_affinity_score, recommendation_score
FROM scored s JOIN now ON s.user_id = now.user_id AND s.track_a_id = now.track_id
ORDER BY recommendation_score DESC, track_b_id LIMIT 10"""


@query("recommend_for_current", with_tables("scored", "playing") + _NOW)
def _recommend_for_current(spark, sf):
    recs = recommend.recommend_for_current(bridge.currently_playing(spark, sf), bridge.scored(spark, sf))
    return recs.select(
        "user_id", "track_a_id", "track_b_id", "cooccurrence_score", "artist_affinity_score", "recommendation_score"
    )


@query("recommendation_coverage", with_tables("cooc") + """
SELECT c.user_id, count(DISTINCT c.track_b_id) AS total_cooccurrence_tracks,
       count(DISTINCT p.track_id) AS tracks_already_played,
       count(DISTINCT c.track_b_id) - count(DISTINCT p.track_id) AS new_recommendations
FROM cooc c LEFT JOIN silver p ON c.user_id = p.user_id AND c.track_b_id = p.track_id GROUP BY 1""")
def _recommendation_coverage(spark, sf):
    silver = bridge.stored_silver(spark, sf)
    return recommend.recommendation_coverage(recommend.track_cooccurrence(silver, WIDE_GAP), silver)
