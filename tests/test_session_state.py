"""Sessions kept load by load beside those found over all plays at once."""

import random

import pytest
from pyspark.sql import functions as F

from earshot.operators import session_state, sessions

SCHEMA = "user_id string, played_at timestamp_ntz, event_id long"


def _plays(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        minute = rng.choice([rng.randrange(6000), 60 * rng.randrange(100) + rng.choice([0, 59])])
        at = None if rng.random() < 0.02 else f"2024-01-0{1 + minute // 1440} {minute // 60 % 24:02d}:{minute % 60:02d}:{rng.randrange(60):02d}"
        rows.append((rng.choice(["u1", "u1", "u2", "u3", "u4", None]), at, k))
    raw = spark.createDataFrame(rows, "user_id string, played_at string, event_id long")
    return raw.withColumn("played_at", F.col("played_at").cast("timestamp_ntz"))


def _batch(plays, gap):
    found = sessions.sessionize(plays, gap).groupBy("user_id", "session_id")
    return found.agg(F.min("played_at").alias("session_start"), F.max("played_at").alias("session_end"), F.count("*").alias("plays"))


def _rows(df):
    return sorted((str(tuple(r)) for r in df.select("user_id", "session_id", "session_start", "session_end", "plays").collect()))


@pytest.mark.parametrize(("seed", "gap"), [(1, 60), (2, 5), (3, 240)])
def test_ten_loads_in_any_order_give_the_batch_result(spark, tmp_path, seed, gap):
    plays = _plays(spark, seed).cache()
    turns = list(range(10))
    random.Random(seed).shuffle(turns)
    for load, turn in enumerate(turns):
        session_state.load_plays(spark, f"{tmp_path}/s", plays.filter(F.col("event_id") % 10 == turn), load, gap, parts=4)
    assert _rows(session_state.stored_sessions(spark, f"{tmp_path}/s")) == _rows(_batch(plays, gap))
    assert session_state.prune_loads(spark, f"{tmp_path}/s") > 0
    assert _rows(session_state.stored_sessions(spark, f"{tmp_path}/s")) == _rows(_batch(plays, gap))


def test_other_folders_are_neither_read_nor_written(spark, tmp_path):
    root = f"{tmp_path}/s"
    plays = _plays(spark, 4)
    parts = session_state.load_plays(spark, root, plays, 0, parts=16)
    late = plays.filter("user_id = 'u2'").withColumn("played_at", F.col("played_at") + F.expr("INTERVAL 3 DAYS"))
    hit = session_state.load_plays(spark, root, late, 1, parts=16)
    assert len(hit) == 1 < len(parts)
    written = {p.name for p in (tmp_path / "s" / "load=000000001").iterdir() if p.name.startswith("part=")}
    assert written == {f"part={hit[0]}"}
    # What cannot be read is not read: the other folders hold no Parquet any more.
    for part in (tmp_path / "s" / "load=000000000").iterdir():
        if part.name.startswith("part=") and part.name != f"part={hit[0]}":
            for file in part.glob("*.parquet"):
                file.write_bytes(b"no longer Parquet")
            for crc in part.glob(".*.crc"):
                crc.unlink()
    assert session_state.load_plays(spark, root, late, 2, parts=16) == hit


def test_a_load_that_runs_again_replaces_itself(spark, tmp_path):
    root, plays = f"{tmp_path}/s", _plays(spark, 5).cache()
    first, second = plays.filter("event_id % 2 = 0"), plays.filter("event_id % 2 = 1")
    session_state.load_plays(spark, root, first, 0)
    session_state.load_plays(spark, root, second, 1)
    (tmp_path / "s" / "load=000000001" / "_SUCCESS").unlink()
    assert _rows(session_state.stored_sessions(spark, root)) == _rows(_batch(first, 60))
    session_state.load_plays(spark, root, second, 1)
    session_state.load_plays(spark, root, second, 1)
    assert _rows(session_state.stored_sessions(spark, root)) == _rows(_batch(plays, 60))


def test_nothing_to_load(spark, tmp_path):
    assert session_state.load_plays(spark, f"{tmp_path}/s", spark.createDataFrame([], SCHEMA), 0) == []
    assert session_state.stored_sessions(spark, f"{tmp_path}/s").count() == 0
