"""Questions asked of the tables: counts, duplicates, gaps, recent and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import blended_score, ms_to_hours, ms_to_minutes, percent_of_total, raw_affinity, round_ratio
from ..functions.text import reasoning_text
from ..operators import gold, monitors, profile, recommend, reshape, sessions
from ..operators import silver as silver_ops
from ..session import materialize
from . import bridge
from .bridge import WIDE_GAP, with_tables
from .registry import query


@query("having_duplicates", with_tables("bronze") + """
SELECT user_id, track_id, played_at, count(*) AS occurrences FROM bronze GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _having_duplicates(spark, sf):
    return profile.having_duplicates(bridge.bronze(spark, sf), "user_id", "track_id", "played_at")


@query("bronze_duplicate_ids", with_tables("bronze") + """
SELECT event_id, count(*) AS occurrences FROM bronze GROUP BY 1 HAVING count(*) > 1""")
def _bronze_duplicate_ids(spark, sf):
    return profile.having_duplicates(bridge.bronze(spark, sf), "event_id")


@query("dq_assessment", with_tables("bronze") + """
SELECT count(*) AS total_records, count(*) FILTER (user_id IS NULL) AS null_user_ids,
       count(*) FILTER (duration_ms <= 0) AS invalid_durations,
       count(*) FILTER (duration_ms > 600000) AS suspiciously_long_tracks
FROM bronze""")
def _dq_assessment(spark, sf):
    return profile.dq_assessment(bridge.bronze(spark, sf))


@query("dedup_verify", with_tables("silver") + """
SELECT count(*) AS total_records, count(DISTINCT event_id) AS unique_event_ids,
       count(DISTINCT (user_id, track_id, played_at)) AS unique_plays FROM silver""")
def _dedup_verify(spark, sf):
    return profile.dedup_verify(bridge.silver(spark, sf))


@query("track_id_consistency", with_tables("silver") + """
SELECT track_name, count(DISTINCT track_id) AS unique_ids, count(*) AS total_plays FROM silver GROUP BY 1""")
def _track_id_consistency(spark, sf):
    return profile.track_id_consistency(bridge.silver(spark, sf))


@query("user_breakdown", with_tables("silver") + """
SELECT user_id, count(*) AS play_count, min(played_at) AS first_play, max(played_at) AS last_play FROM silver GROUP BY 1""")
def _user_breakdown(spark, sf):
    return profile.user_breakdown(bridge.silver(spark, sf))


_RANGE = """count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks, min(played_at) AS earliest_play,
max(played_at) AS latest_play, date_diff('day', min(played_at), max(played_at)) AS days_of_data FROM silver"""


@query("data_range_profile", with_tables("silver") + f"SELECT {_RANGE}")
def _data_range_profile(spark, sf):
    return profile.data_range_profile(bridge.silver(spark, sf))


@query("data_range_per_user", with_tables("silver") + f"SELECT user_id, {_RANGE} GROUP BY user_id")
def _data_range_per_user(spark, sf):
    return profile.data_range_profile(bridge.silver(spark, sf), "user_id")


@query("processed_at_profile", with_tables("silver") + """
SELECT min(CAST(played_at AS DATE) + INTERVAL 1 DAY) AS earliest_processed, max(CAST(played_at AS DATE) + INTERVAL 1 DAY) AS latest_processed,
       count(DISTINCT CAST(played_at AS DATE)) AS unique_timestamps FROM silver""")
def _processed_at_profile(spark, sf):
    """Each day's plays are processed in the night after."""
    night = F.timestamp_add("DAY", F.lit(1), F.date_trunc("day", "played_at").cast("timestamp"))
    out = profile.processed_at_profile(bridge.silver(spark, sf).withColumn("processed_at", night))
    moments = ("earliest_processed", "latest_processed")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in moments})


@query("session_summary", with_tables("sessioned") + """
SELECT user_id, session_id, count(*) AS tracks_in_session, min(played_at) AS session_start, max(played_at) AS session_end,
       date_diff('minute', min(played_at), max(played_at)) AS session_duration_minutes,
       string_agg(DISTINCT track_name, ' | ' ORDER BY track_name) AS tracks_played
FROM sessioned GROUP BY 1, 2""")
def _session_summary(spark, sf):
    return sessions.session_summary(sessions.sessionize(bridge.silver(spark, sf), WIDE_GAP))


@query("play_gaps", with_tables("sessioned") + """
SELECT user_id, track_name, played_at, prev AS previous_play, date_diff('minute', prev, played_at) AS minutes_since_last
FROM sessioned""")
def _play_gaps(spark, sf):
    out = sessions.play_gaps(bridge.silver(spark, sf))
    return out.select("user_id", "track_name", "played_at", "previous_play", "minutes_since_last")


_SEEN = """
, seen AS (SELECT *, lag(track_id) OVER w AS previous_track_id, lag(track_name) OVER w AS previous_track_name,
                  lag(detected_at) OVER w AS previous_detection
           FROM playing WINDOW w AS (PARTITION BY user_id ORDER BY detected_at, track_id))
"""


@query("track_change_report", with_tables("playing") + _SEEN + """
SELECT user_id, detected_at, track_id, track_name, previous_track_id, previous_track_name,
       CASE WHEN track_id <> previous_track_id THEN 'TRACK CHANGE' ELSE 'SAME TRACK' END AS change_status FROM seen""")
def _track_change_report(spark, sf):
    out = sessions.track_change_report(bridge.currently_playing(spark, sf))
    return out.select(
        "user_id", "detected_at", "track_id", "track_name", "previous_track_id", "previous_track_name", "change_status"
    )


@query("case_bucket", with_tables("playing") + _SEEN + """
SELECT CASE WHEN track_id <> previous_track_id THEN 'TRACK CHANGE' ELSE 'SAME TRACK' END AS change_status,
       count(*) AS detections FROM seen GROUP BY 1""")
def _case_bucket(spark, sf):
    out = sessions.track_change_report(bridge.currently_playing(spark, sf))
    return out.groupBy("change_status").agg(F.count("*").alias("detections"))


@query("poll_latency", with_tables("playing") + _SEEN + """
SELECT user_id, detected_at, track_name, previous_detection,
       date_diff('second', previous_detection, detected_at) AS seconds_since_last FROM seen""")
def _poll_latency(spark, sf):
    out = sessions.poll_latency(bridge.currently_playing(spark, sf))
    return out.select("user_id", "detected_at", "track_name", "previous_detection", "seconds_since_last")


@query("playback_state_summary", with_tables("playing") + """
SELECT is_playing, count(*) AS detection_count, min(detected_at) AS first_detection, max(detected_at) AS last_detection
FROM playing GROUP BY 1""")
def _playback_state_summary(spark, sf):
    return profile.playback_state_summary(bridge.currently_playing(spark, sf))


@query("recommendation_counts", with_tables("cooc") + """
SELECT user_id, track_a_id, track_a_name, track_a_artist, count(*) AS recommendation_count
FROM cooc GROUP BY 1, 2, 3, 4 ORDER BY recommendation_count DESC, user_id, track_a_id LIMIT 10""")
def _recommendation_counts(spark, sf):
    counted = bridge.cooccurrence(spark, sf).groupBy("user_id", "track_a_id", "track_a_name", "track_a_artist").agg(
        F.count("*").alias("recommendation_count")
    )
    return profile.top_k(counted, 10, F.col("recommendation_count").desc(), "user_id", "track_a_id")


@query("row_count", with_tables("bronze") + "SELECT count(*) AS total_rows FROM bronze")
def _row_count(spark, sf):
    return bridge.bronze(spark, sf).agg(F.count("*").alias("total_rows"))


@query("distinct_count", with_tables("silver") + "SELECT count(DISTINCT track_id) AS unique_tracks FROM silver")
def _distinct_count(spark, sf):
    return bridge.silver(spark, sf).agg(F.countDistinct("track_id").alias("unique_tracks"))


@query("pair_totals", with_tables("pairs") + """
SELECT count(*) AS total_pairs, count(DISTINCT (user_id, session_id)) AS sessions_with_pairs FROM pairs""")
def _pair_totals(spark, sf):
    return profile.pair_totals(recommend.session_pairs(bridge.stored_items(spark, sf)))


@query("cooccurrence_stats", with_tables("cooc") + """
SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_users, max(cooccurrence_score) AS max_score,
       min(cooccurrence_score) AS min_score FROM cooc""")
def _cooccurrence_stats(spark, sf):
    return profile.model_stats(bridge.cooccurrence(spark, sf), "cooccurrence_score")


@query("affinity_stats", with_tables("affinity") + """
SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_users, max(affinity_score) AS max_score,
       min(affinity_score) AS min_score FROM affinity""")
def _affinity_stats(spark, sf):
    return profile.model_stats(bridge.affinity(spark, sf), "affinity_score")


@query("model_stats", with_tables("recs") + """
SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_users, max(recommendation_score) AS max_score,
       min(recommendation_score) AS min_score FROM recs""")
def _model_stats(spark, sf):
    recs = recommend.track_recommendations(*bridge.pairs_and_affinity(spark, sf))
    return profile.model_stats(recs, "recommendation_score")


@query("overview_daily_sum", with_tables("daily") + """
SELECT CAST(sum(total_plays) AS BIGINT) AS total_plays, CAST(sum(unique_tracks) AS BIGINT) AS unique_tracks,
       CAST(sum(unique_artists) AS BIGINT) AS unique_artists,
       round(CAST(sum(total_listening_time_ms) AS BIGINT) / 1000 / 60, 6) AS total_minutes,
       min(date) AS first_date, max(date) AS last_date FROM daily""")
def _overview(spark, sf):
    return profile.overview(gold.daily_user_stats(bridge.silver(spark, sf)))


@query("overview_exact", with_tables("silver") + """
SELECT count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks, count(DISTINCT artist_name) AS unique_artists
FROM silver""")
def _overview_exact(spark, sf):
    """Plays are summed per track and artist first: the distinct counts see one row for each."""
    return bridge.silver(spark, sf).groupBy("track_id", "artist_name").agg(F.count("*").alias("_n")).agg(
        F.sum("_n").alias("total_plays"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.countDistinct("artist_name").alias("unique_artists"),
    )


@query("trends", with_tables("daily") + """
SELECT date, CAST(sum(total_plays) AS BIGINT) AS total_plays,
       round(CAST(sum(total_listening_time_ms) AS BIGINT) / 1000 / 60 / 60, 6) AS listening_hours FROM daily GROUP BY 1""")
def _trends(spark, sf):
    return profile.trends(gold.daily_user_stats(bridge.silver(spark, sf)))


@query("cross_join_scalar", with_tables("devices") + "SELECT device_type, play_percentage FROM devices")
def _cross_join_scalar(spark, sf):
    return gold.device_usage(bridge.silver(spark, sf)).select("device_type", "play_percentage")


@query("percent_of_total", with_tables("tracks") + """
SELECT track_id, round(CAST(total_plays AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM silver) * 100, 2) AS share
FROM tracks""")
def _percent_of_total(spark, sf):
    per_track = bridge.silver(spark, sf).groupBy("track_id", "track_name", "artist_name", "album_name").agg(
        F.count("*").alias("n")
    )
    total = per_track.select(F.sum("n")).scalar()
    return per_track.select("track_id", percent_of_total("n", total).alias("share"))


@query("scalar_subqueries", with_tables("devices") + """
SELECT (SELECT count(*) FROM silver) AS silver_count,
       (SELECT CAST(sum(total_plays) AS BIGINT) FROM devices) AS gold_total_plays""")
def _scalar_subqueries(spark, sf):
    silver = bridge.stored_silver(spark, sf)
    return monitors.cross_layer_totals(silver, gold.device_usage(silver))


@query("global_rank", with_tables("artists") + "SELECT artist_name, rank FROM artists")
def _global_rank(spark, sf):
    return gold.top_artists(bridge.silver(spark, sf)).select("artist_name", "rank")


@query("order_output", with_tables("daily") + "SELECT date, user_id, total_plays FROM daily ORDER BY date DESC, user_id")
def _order_output(spark, sf):
    stats = gold.daily_user_stats(bridge.silver(spark, sf)).select("date", "user_id", "total_plays")
    return stats.orderBy(F.col("date").desc(), "user_id")


@query("latest_row", with_tables("playing") + """
SELECT user_id, detected_at, track_id, track_name, artist_name, album_name, is_playing FROM playing
ORDER BY detected_at DESC, user_id, track_id LIMIT 1""")
def _latest_row(spark, sf):
    latest = recommend.latest_row(bridge.currently_playing(spark, sf), "detected_at", "user_id", "track_id")
    return latest.select("user_id", "detected_at", "track_id", "track_name", "artist_name", "album_name", "is_playing")


@query("latest_to_recs_join", with_tables("scored", "playing") + """
, now AS (SELECT user_id, track_id FROM playing ORDER BY detected_at DESC, user_id, track_id LIMIT 1)
SELECT track_b_id, track_b_name, track_b_artist, recommendation_score
FROM scored s JOIN now ON s.user_id = now.user_id AND s.track_a_id = now.track_id
ORDER BY recommendation_score DESC, track_b_id LIMIT 10""")
def _latest_to_recs_join(spark, sf):
    recs = recommend.recommend_for_current(bridge.currently_playing(spark, sf), bridge.scored(spark, sf))
    return recs.select("track_b_id", "track_b_name", "track_b_artist", "recommendation_score")


@query("top_k", with_tables("playing") + """
SELECT user_id, detected_at, track_name, artist_name, is_playing, duration_ms FROM playing
ORDER BY detected_at DESC, user_id, track_id LIMIT 20""")
def _top_k(spark, sf):
    rows = bridge.currently_playing(spark, sf)
    columns = ["user_id", "detected_at", "track_name", "artist_name", "is_playing", "duration_ms"]
    return profile.top_k(rows, 20, F.col("detected_at").desc(), "user_id", "track_id", columns=columns)


@query("top_pairs", with_tables("cooc") + """
SELECT user_id, track_a_id, track_b_id, sessions_together, cooccurrence_score FROM cooc
ORDER BY cooccurrence_score DESC, sessions_together DESC, user_id, track_a_id, track_b_id LIMIT 10""")
def _top_pairs(spark, sf):
    columns = ["user_id", "track_a_id", "track_b_id", "sessions_together", "cooccurrence_score"]
    return profile.top_k(
        bridge.cooccurrence(spark, sf), 10, F.col("cooccurrence_score").desc(), F.col("sessions_together").desc(),
        "user_id", "track_a_id", "track_b_id", columns=columns,
    )


@query("top_tracks_adhoc", with_tables("bronze") + """
SELECT track_name, artist_name, count(*) AS play_count FROM bronze GROUP BY 1, 2
ORDER BY play_count DESC, track_name, artist_name LIMIT 10""")
def _top_tracks_adhoc(spark, sf):
    counted = bridge.bronze(spark, sf).groupBy("track_name", "artist_name").agg(F.count("*").alias("play_count"))
    return profile.top_k(counted, 10, F.col("play_count").desc(), "track_name", "artist_name")


@query("top_n_per_group", with_tables("affinity") + """
SELECT user_id, artist_name, affinity_score, rank FROM affinity WHERE rank <= 5""")
def _top_n_per_group(spark, sf):
    return bridge.affinity(spark, sf, top_n=5).select("user_id", "artist_name", "affinity_score", "rank")


@query("distinct_recent", with_tables("silver") + """
SELECT track_id, track_name, artist_name, max(played_at) AS seen_at FROM silver GROUP BY 1, 2, 3
ORDER BY seen_at DESC, track_id, track_name, artist_name LIMIT 10""")
def _distinct_recent(spark, sf):
    return profile.distinct_recent(bridge.silver(spark, sf), ["track_id", "track_name", "artist_name"], "played_at", 10)


@query("first_seen_today", with_tables("playing") + """
SELECT track_id, track_name, artist_name, min(detected_at) AS first_played FROM playing
WHERE CAST(detected_at AS DATE) = DATE '2024-01-30' GROUP BY 1, 2, 3
ORDER BY first_played DESC, track_id, track_name, artist_name LIMIT 10""")
def _first_seen_today(spark, sf):
    today = bridge.currently_playing(spark, sf).filter(F.to_date("detected_at") == F.lit("2024-01-30").cast("date"))
    return profile.distinct_recent(
        today, ["track_id", "track_name", "artist_name"], "detected_at", 10, F.min, "first_played"
    )


@query("layer_counts", with_tables("silver") + """
SELECT 'BRONZE' AS layer, count(*) AS row_count FROM bronze UNION ALL SELECT 'SILVER', count(*) FROM silver""")
def _layer_counts(spark, sf):
    return profile.labelled_counts({"BRONZE": bridge.bronze(spark, sf), "SILVER": bridge.silver(spark, sf)})


@query("layer_counts_per_user", with_tables("silver") + """
SELECT 'BRONZE' AS layer, user_id, count(*) AS row_count FROM bronze WHERE user_id IS NOT NULL GROUP BY 2
UNION ALL SELECT 'SILVER', user_id, count(*) FROM silver GROUP BY 2""")
def _layer_counts_per_user(spark, sf):
    def per_user(df, layer):
        counted = df.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count("*").alias("row_count"))
        return counted.select(F.lit(layer).alias("layer"), "*")

    return per_user(bridge.bronze(spark, sf), "BRONZE").unionByName(per_user(bridge.silver(spark, sf), "SILVER"))


@query("model_counts", with_tables("recs") + """
SELECT 'Track Co-occurrence' AS model, count(*) AS row_count, max(cooccurrence_score) AS max_score FROM cooc
UNION ALL SELECT 'Artist Affinity', count(*), max(affinity_score) FROM affinity
UNION ALL SELECT 'Track Recommendations', count(*), max(recommendation_score) FROM recs""")
def _model_counts(spark, sf):
    cooc, liked = map(materialize, bridge.pairs_and_affinity(spark, sf))
    tables = {
        "Track Co-occurrence": cooc.withColumnRenamed("cooccurrence_score", "score"),
        "Artist Affinity": liked.withColumnRenamed("affinity_score", "score"),
        "Track Recommendations": recommend.track_recommendations(cooc, liked).withColumnRenamed(
            "recommendation_score", "score"
        ),
    }
    return profile.labelled_counts(tables, "model", F.max("score").alias("max_score"))


_SAMPLE = "ORDER BY played_at, event_id NULLS LAST, track_id LIMIT 3"


@query("union_samples", with_tables("silver") + f"""
SELECT * FROM (SELECT 'BRONZE' AS source, event_id, track_name, duration_ms FROM bronze {_SAMPLE})
UNION ALL SELECT * FROM (SELECT 'SILVER', event_id, track_name, duration_ms FROM silver {_SAMPLE})""")
def _union_samples(spark, sf):
    def sample(df, layer):
        rows = profile.top_k(df, 3, "played_at", F.col("event_id").asc_nulls_last(), "track_id")
        return rows.select(F.lit(layer).alias("source"), "event_id", "track_name", "duration_ms")

    return sample(bridge.bronze(spark, sf), "BRONZE").unionByName(sample(bridge.silver(spark, sf), "SILVER"))


@query("limit_sample", with_tables("silver") + """
SELECT event_id, user_id, track_name, artist_name, duration_ms, played_at FROM silver
ORDER BY played_at, event_id LIMIT 5""")
def _limit_sample(spark, sf):
    columns = ["event_id", "user_id", "track_name", "artist_name", "duration_ms", "played_at"]
    return profile.top_k(bridge.silver(spark, sf), 5, "played_at", "event_id", columns=columns)


@query("distinct_rows", with_tables("silver") + "SELECT DISTINCT user_id, track_id FROM silver")
def _distinct_rows(spark, sf):
    return bridge.silver(spark, sf).select("user_id", "track_id").distinct()


@query("coverage_left_join", with_tables("cooc") + """
SELECT count(DISTINCT (c.user_id, c.track_b_id)) AS total_cooccurrence_tracks,
       count(DISTINCT (p.user_id, p.track_id)) FILTER (p.track_id IS NOT NULL) AS tracks_already_played,
       count(DISTINCT (c.user_id, c.track_b_id)) - count(DISTINCT (p.user_id, p.track_id)) FILTER (p.track_id IS NOT NULL)
         AS new_recommendations
FROM cooc c LEFT JOIN silver p ON c.user_id = p.user_id AND c.track_b_id = p.track_id
  AND p.played_at >= TIMESTAMP '2024-01-24 00:00:00'""")
def _coverage_left_join(spark, sf):
    """Against what was played in the last week."""
    silver = bridge.stored_silver(spark, sf)
    lately = silver.filter(F.col("played_at") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    per_user = recommend.recommendation_coverage(recommend.track_cooccurrence(silver, WIDE_GAP), lately)
    names = ["total_cooccurrence_tracks", "tracks_already_played", "new_recommendations"]
    return per_user.agg(*[F.sum(n).alias(n) for n in names])


@query("like_filter", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority ILIKE '%medium' OR o_orderpriority LIKE '1-%'""")
def _like_filter(spark, sf):
    orders = bridge.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return orders.filter(F.col("o_orderpriority").ilike("%medium") | F.col("o_orderpriority").like("1-%"))


@query("variant_extract", with_tables("plays") + """
SELECT event_id, user_id, event_type, track_id, track_name, artist_name, album_name, duration_ms, played_at, device_type
FROM plays""")
def _variant_extract(spark, sf):
    """Plays as one semi-structured value per row, read back by path and type."""
    raw = bridge.plays(spark, sf).select(F.parse_json(F.to_json(F.struct("*"))).alias("value"))
    return silver_ops.extract_plays(raw)


@query("reasoning_text", with_tables("scored") + """
SELECT CASE WHEN cooccurrence_score >= 0.8 THEN 'Frequently' WHEN cooccurrence_score >= 0.5 THEN 'Often' ELSE 'Sometimes' END
       || ' played together (' || sessions_together || ' sessions)'
       || CASE WHEN artist_affinity_score >= 80 THEN ', artist is highly preferred'
               WHEN artist_affinity_score >= 50 THEN ', artist is well-liked' ELSE '' END AS reasoning, count(*) AS n
FROM scored GROUP BY 1""")
def _reasoning_text(spark, sf):
    scored = recommend.score_candidates(*bridge.pairs_and_affinity(spark, sf))
    reason = reasoning_text("cooccurrence_score", "artist_affinity_score", "sessions_together")
    return scored.groupBy(reason.alias("reasoning")).agg(F.count("*").alias("n"))


@query("weighted_score", with_tables("raw_affinity", "scored") + """
SELECT 'affinity' AS kind, user_id, artist_name AS item, CAST(raw / 10 AS DOUBLE) AS score FROM raw_affinity
UNION ALL SELECT 'blend', user_id, track_a_id || '>' || track_b_id, recommendation_score FROM scored""")
def _weighted_score(spark, sf):
    recent = F.col("played_at") >= F.lit("2024-01-24").cast("timestamp_ntz")
    silver, cooc, liked = bridge.model_tables(spark, sf)
    per_artist = silver.groupBy("user_id", F.col("artist_name").alias("item")).agg(
        raw_affinity(F.sum(F.when(recent, 2).otherwise(1)), F.countDistinct("track_id")).cast("double").alias("score")
    )
    scored = recommend.score_candidates(cooc, liked)
    blend = scored.select(
        "user_id",
        F.concat_ws(">", "track_a_id", "track_b_id").alias("item"),
        blended_score("cooccurrence_score", "artist_affinity_score").alias("score"),
    )
    return per_artist.select(F.lit("affinity").alias("kind"), "*").unionByName(
        blend.select(F.lit("blend").alias("kind"), "*")
    )


@query("round_ratio", with_tables("daily") + """
SELECT date, user_id, round(CAST(unique_tracks AS DOUBLE) / total_plays, 3) AS variety FROM daily""")
def _round_ratio(spark, sf):
    stats = gold.daily_user_stats(bridge.silver(spark, sf))
    return stats.select("date", "user_id", round_ratio("unique_tracks", "total_plays").alias("variety"))


@query("ms_to_minutes_hours", with_tables("tracks") + """
SELECT track_id, round(total_listening_time_ms / 1000 / 60, 6) AS minutes,
       round(total_listening_time_ms / 1000 / 60 / 60, 6) AS hours FROM tracks""")
def _ms_to_minutes_hours(spark, sf):
    per_track = bridge.silver(spark, sf).groupBy("track_id", "track_name", "artist_name", "album_name").agg(
        F.sum("duration_ms").alias("ms")
    )
    return per_track.select(
        "track_id", F.round(ms_to_minutes("ms"), 6).alias("minutes"), F.round(ms_to_hours("ms"), 6).alias("hours")
    )


@query("group_by_ordinals", """
SELECT c_nationkey, c_mktsegment, count(*) AS customers FROM customer GROUP BY 1, 2""")
def _group_by_ordinals(spark, sf):
    rows = bridge.table(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    return reshape.group_by_ordinals(rows, 2, F.count("*").alias("customers"))
