"""Table schemas. Bronze keeps ``played_at`` as text, silver types it."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STRING, LONG, INT, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
NTZ = T.TimestampNTZType()

PLAY_EVENT = _struct(
    event_id=STRING,
    user_id=STRING,
    event_type=STRING,
    track_id=STRING,
    track_name=STRING,
    artist_name=STRING,
    album_name=STRING,
    duration_ms=LONG,
    played_at=STRING,
    device_type=STRING,
)

SILVER_PLAYS = T.StructType(
    [f if f.name != "played_at" else T.StructField("played_at", NTZ, True) for f in PLAY_EVENT.fields]
    + [T.StructField("processed_at", T.TimestampType(), True)]
)

CURRENTLY_PLAYING = _struct(
    detected_at=NTZ,
    track_id=STRING,
    track_name=STRING,
    artist_name=STRING,
    album_name=STRING,
    is_playing=BOOL,
    progress_ms=INT,
    duration_ms=INT,
    device_type=STRING,
    device_name=STRING,
    shuffle_state=BOOL,
    repeat_state=STRING,
    context_type=STRING,
    context_uri=STRING,
)

_ARTIST = _struct(name=STRING)
_TRACK = T.StructType(
    [
        T.StructField("id", STRING),
        T.StructField("name", STRING),
        T.StructField("artists", T.ArrayType(_ARTIST)),
        T.StructField("album", _struct(name=STRING)),
        T.StructField("duration_ms", LONG),
    ]
)

RECENTLY_PLAYED_PAGE = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("track", _TRACK),
                        T.StructField("played_at", STRING),
                        T.StructField("context", _struct(type=STRING)),
                    ]
                )
            ),
        )
    ]
)

PLAYBACK_STATE = T.StructType(
    [
        T.StructField("item", _TRACK),
        T.StructField("device", _struct(type=STRING, name=STRING)),
        T.StructField("context", _struct(type=STRING, uri=STRING)),
        T.StructField("is_playing", BOOL),
        T.StructField("progress_ms", INT),
        T.StructField("shuffle_state", BOOL),
        T.StructField("repeat_state", STRING),
    ]
)

TEST_RESULT = _struct(test_name=STRING, status=STRING, failures=LONG, executed_at=NTZ)

RUN_LOG = _struct(
    job=STRING, run_type=STRING, state=STRING, scheduled_at=NTZ, started_at=NTZ, ended_at=NTZ
)
