"""Plays made from the ``events`` table, and the same tables as SQL.

``plays`` maps events to plays one to one. ``bronze`` adds what real landing
data has: missing ids and repeated deliveries under another event id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import try_cast_ts
from ..operators import recommend
from ..operators import silver as silver_ops
from ..operators.models import Model, Models, Source, files_version, listening_models
from ..schemas import PLAY_EVENT
from ..session import materialize, own_path
from ..sources.tables import external_table_scan, write_bronze

AS_OF = "2024-01-31 00:00:00"
WIDE_GAP = 1440


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("_k")
    return (
        table(spark, sf_dir, "events")
        .withColumn("_k", F.get_json_object("props", "$.k").cast("int"))
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            "event_type",
            F.concat(F.lit("track_"), k).alias("track_id"),
            F.concat(F.lit("Track "), k).alias("track_name"),
            F.concat(F.lit("Artist "), k % 10).alias("artist_name"),
            F.concat(F.lit("Album "), k % 25).alias("album_name"),
            (F.round(F.col("value") * 100).cast("long") * 50).alias("duration_ms"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("played_at"),
            F.element_at(F.array(*map(F.lit, ["desktop", "mobile", "tablet"])), (F.col("event_id") % 3).cast("int") + 1).alias(
                "device_type"
            ),
        )
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan: a repeat is a second entry of the ids array of its row, not a union.

    Missing ids are only in the first delivery; the repeat is complete.
    """
    n = F.col("event_id").cast("long")
    ids = F.struct(
        F.when(n % 97 != 0, F.col("event_id")).alias("event_id"), F.when(n % 89 != 0, F.col("user_id")).alias("user_id")
    )
    again = F.struct((n + 100_000_000).cast("string").alias("event_id"), F.col("user_id"))
    deliveries = F.when(n % 20 == 0, F.array(ids, again)).otherwise(F.array(ids))
    rest = [c for c in PLAY_EVENT.fieldNames() if c not in ("event_id", "user_id")]
    return plays(spark, sf_dir).select(F.inline(deliveries), *rest)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_ops.silver_plays(bronze(spark, sf_dir), AS_OF)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written table, for queries that read it more than once."""
    return materialize(silver(spark, sf_dir), "silver")


def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was heard in each session, as a written table."""
    return materialize(recommend.session_items(silver(spark, sf_dir), WIDE_GAP), "items")


def cooccurrence(spark: SparkSession, sf_dir: str, gap: int = WIDE_GAP, **options) -> DataFrame:
    return recommend.track_cooccurrence(silver(spark, sf_dir), gap, **options)


def affinity(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return recommend.artist_affinity(silver(spark, sf_dir), AS_OF, **options)


def model_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver as a written table, and both inputs of the recommendations built from it."""
    stored = stored_silver(spark, sf_dir)
    return stored, recommend.track_cooccurrence(stored, WIDE_GAP), recommend.artist_affinity(stored, AS_OF)


def pairs_and_affinity(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return model_tables(spark, sf_dir)[1:]


GOLD = ("daily_user_stats", "top_tracks", "top_artists", "device_usage")


def _landed_bronze(bronze):
    return bronze


#: Bronze as hourly files, stored beside the other tables.
LANDED = Model(
    "landed_bronze", _landed_bronze, write=lambda df, path: write_bronze(df, path, mode="overwrite"), read=external_table_scan
)


def models(spark: SparkSession, sf_dir: str, root: str | None = None) -> Models:
    """All stored tables over the given events, in versions that follow the event files."""
    events = Source(lambda: bronze(spark, sf_dir), files_version(spark, f"{sf_dir}/events.parquet"))
    listed = [*listening_models(AS_OF, WIDE_GAP), LANDED]
    return Models(spark, root or own_path(spark, "models"), listed, {"bronze": events})


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).table("scored_pairs")


def currently_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playback detections: one per play, at its time."""
    return plays(spark, sf_dir).select(
        "user_id",
        try_cast_ts("played_at").alias("detected_at"),
        "track_id",
        "track_name",
        "artist_name",
        "album_name",
        (F.col("device_type") != "tablet").alias("is_playing"),
        "duration_ms",
        "device_type",
    )


_PARTS = {
    "plays": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       'track_' || k AS track_id, 'Track ' || k AS track_name,
       'Artist ' || (k % 10) AS artist_name, 'Album ' || (k % 25) AS album_name,
       CAST(round(value * 100) AS BIGINT) * 50 AS duration_ms,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS played_at,
       CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
       event_id AS n, ts
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    "bronze": """
SELECT CASE WHEN n % 97 = 0 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN n % 89 = 0 THEN NULL ELSE user_id END AS user_id,
       event_type, track_id, track_name, artist_name, album_name, duration_ms, played_at, device_type, ts
FROM plays
UNION ALL
SELECT CAST(n + 100000000 AS VARCHAR), user_id, event_type, track_id, track_name, artist_name, album_name,
       duration_ms, played_at, device_type, ts
FROM plays WHERE n % 20 = 0""",
    "silver": """
SELECT event_id, user_id, event_type, track_id, track_name, artist_name, album_name, duration_ms,
       ts AS played_at, device_type
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, track_id, played_at ORDER BY event_id) AS rn
      FROM bronze
      WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND duration_ms > 0 AND duration_ms < 600000)
WHERE rn = 1""",
    "daily": """
SELECT CAST(played_at AS DATE) AS date, user_id, count(*) AS total_plays,
       CAST(sum(duration_ms) AS BIGINT) AS total_listening_time_ms,
       count(DISTINCT track_id) AS unique_tracks, count(DISTINCT artist_name) AS unique_artists,
       CAST(CAST(round(sum(duration_ms) / count(*), 2) AS DECIMAL(38,0)) AS BIGINT) AS avg_track_duration_ms
FROM silver GROUP BY 1, 2""",
    "tracks": """
SELECT *, row_number() OVER (ORDER BY total_plays DESC, total_listening_time_ms DESC,
                             track_id, track_name, artist_name, album_name) AS rank
FROM (SELECT track_id, track_name, artist_name, album_name, count(*) AS total_plays,
             CAST(sum(duration_ms) AS BIGINT) AS total_listening_time_ms,
             min(played_at) AS first_played_at, max(played_at) AS last_played_at
      FROM silver GROUP BY 1, 2, 3, 4)""",
    "artists": """
SELECT *, row_number() OVER (ORDER BY total_plays DESC, total_listening_time_ms DESC, artist_name) AS rank
FROM (SELECT artist_name, count(*) AS total_plays, CAST(sum(duration_ms) AS BIGINT) AS total_listening_time_ms,
             count(DISTINCT track_id) AS unique_tracks,
             min(played_at) AS first_played_at, max(played_at) AS last_played_at
      FROM silver GROUP BY 1)""",
    "devices": """
SELECT device_type, count(*) AS total_plays, CAST(sum(duration_ms) AS BIGINT) AS total_listening_time_ms,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM silver) * 100, 2) AS play_percentage,
       CAST(CAST(round(sum(duration_ms) / count(*), 2) AS DECIMAL(38,0)) AS BIGINT) AS avg_track_duration_ms
FROM silver GROUP BY 1""",
    # A play's session is one more than the starts among the user's distinct minutes up to its own.
    "sessioned": """
SELECT p.*, lag(p.played_at) OVER (PARTITION BY p.user_id ORDER BY p.played_at, p.event_id) AS prev, CAST(m.starts_so_far AS BIGINT) AS session_id
FROM silver p JOIN (
  SELECT user_id, minute, count(*) FILTER (is_start) OVER (PARTITION BY user_id ORDER BY minute) AS starts_so_far
  FROM (SELECT user_id, minute, coalesce(minute - max(minute) OVER (PARTITION BY user_id ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                                         > INTERVAL 1 MINUTE * {gap}, true) AS is_start
        FROM (SELECT DISTINCT user_id, date_trunc('minute', played_at) AS minute FROM silver))) m
  ON m.user_id = p.user_id AND m.minute = date_trunc('minute', p.played_at)""",
    "heard": """
SELECT user_id, session_id, track_id, track_name, artist_name FROM sessioned GROUP BY ALL""",
    "pairs": """
SELECT user_id, session_id, x.track_id AS track_a_id, x.track_name AS track_a_name, x.artist_name AS track_a_artist,
       y.track_id AS track_b_id, y.track_name AS track_b_name, y.artist_name AS track_b_artist
FROM heard x JOIN heard y USING (user_id, session_id) WHERE y.track_id > x.track_id""",
    "cooc": """
SELECT p.*, t.total_sessions AS track_a_total_sessions,
       round(CAST(p.sessions_together AS DOUBLE) / t.total_sessions, 3) AS cooccurrence_score
FROM (SELECT user_id, track_a_id, track_a_name, track_a_artist, track_b_id, track_b_name, track_b_artist,
             count(DISTINCT session_id) AS sessions_together
      FROM pairs GROUP BY ALL) p
JOIN (SELECT user_id, track_id, count(DISTINCT session_id) AS total_sessions FROM sessioned GROUP BY 1, 2) t
  ON p.user_id = t.user_id AND p.track_a_id = t.track_id""",
    "raw_affinity": """
SELECT user_id, artist_name, count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks,
       CAST(sum(CASE WHEN played_at >= TIMESTAMP '2024-01-24 00:00:00' THEN 2 ELSE 1 END) AS BIGINT) AS weighted_plays,
       sum(CASE WHEN played_at >= TIMESTAMP '2024-01-24 00:00:00' THEN 2 ELSE 1 END) * 6
         + count(DISTINCT track_id) * 4 AS raw
FROM silver GROUP BY 1, 2""",
    "affinity": """
SELECT * EXCLUDE (raw) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY affinity_score DESC NULLS FIRST, artist_name) AS rank
  FROM (SELECT *, CAST(round(CAST(round(CAST(raw - min(raw) OVER () AS DOUBLE)
                 / nullif(max(raw) OVER () - min(raw) OVER (), 0), 7) AS DECIMAL(18,7)) * 100, 2) AS DOUBLE)
               AS affinity_score FROM raw_affinity))
WHERE rank <= 50""",
    "scored": """
SELECT c.*, coalesce(a.affinity_score, 0) AS artist_affinity_score,
       CAST(round(CAST(c.cooccurrence_score AS DECIMAL(9,3)) * 0.7
                  + CAST(coalesce(a.affinity_score, 0) AS DECIMAL(9,2)) * 0.003, 3) * 100 AS DOUBLE) AS recommendation_score
FROM cooc c LEFT JOIN affinity a ON c.user_id = a.user_id AND c.track_b_artist = a.artist_name""",
    "recs": """
SELECT * FROM (
  SELECT user_id, track_b_id AS recommended_track_id, track_b_name AS recommended_track_name,
         track_b_artist AS recommended_artist, cooccurrence_score, artist_affinity_score, recommendation_score,
         track_a_name AS based_on_track, track_a_artist AS based_on_artist,
         row_number() OVER (PARTITION BY user_id ORDER BY recommendation_score DESC, track_a_id, track_b_id) AS rank
  FROM scored)
WHERE rank <= 50""",
    "playing": """
SELECT user_id, ts AS detected_at, track_id, track_name, artist_name, album_name,
       device_type <> 'tablet' AS is_playing, duration_ms, device_type
FROM plays""",
}
_NEEDS = {
    "bronze": ["plays"],
    "silver": ["bronze"],
    "daily": ["silver"],
    "tracks": ["silver"],
    "artists": ["silver"],
    "devices": ["silver"],
    "sessioned": ["silver"],
    "heard": ["sessioned"],
    "pairs": ["heard"],
    "cooc": ["pairs"],
    "raw_affinity": ["silver"],
    "affinity": ["raw_affinity"],
    "scored": ["cooc", "affinity"],
    "recs": ["scored"],
    "playing": ["plays"],
}


def with_tables(*names: str, gap: int = WIDE_GAP, extra: str = "") -> str:
    """``WITH`` clause that defines the named tables and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    body = ",\n".join(f"{n} AS ({_PARTS[n].format(gap=gap)})" for n in ordered)
    return f"WITH {body}{', ' + extra if extra else ''}\n"
