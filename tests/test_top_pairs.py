"""The best pairs beside those of all pairs, and how many pairs are made for them."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from earshot.operators import recommend, top_pairs


def _items(spark, seed, users=3, sessions=60, tracks=200, names=1):
    """Sessions with a few common tracks and a long tail, as in listening."""
    rng = random.Random(seed)
    rows = set()
    for user in range(users):
        for session in range(sessions if user else 4 * sessions):
            for _ in range(rng.choice([1, 4, 25])):
                t = min(int(tracks * rng.random() ** 3), tracks - 1)
                rows.add((f"u{user}", session, f"t{t:03d}", f"T{t}-{rng.randrange(names)}", f"A{t % 9}", 1))
    return spark.createDataFrame(sorted(rows), "user_id string, session_id long, track_id string, track_name string, artist_name string, plays long")


def _affinity(items, spread=True):
    liked = items.groupBy("user_id", "artist_name").agg(F.countDistinct("track_id").alias("n"))
    score = F.round(F.pmod(F.hash("user_id", "artist_name"), F.lit(1000)) / 10, 1) if spread else F.lit(None)
    return liked.select("user_id", "artist_name", score.cast("double").alias("affinity_score")).filter(F.col("artist_name") != "A3")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("top", "least", "head", "names"), [(3, 1, 4, 1), (20, 2, 32, 1), (1, 3, 2, 2), (500, 1, 1, 2)])
def test_partners_are_those_of_all_pairs(spark, top, least, head, names):
    items = _items(spark, top, names=names)
    w = Window.partitionBy("user_id", "track_a_id").orderBy(F.col("sessions_together").desc())
    every = recommend.score_pairs(items, least).withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= top)
    got = top_pairs.top_partners(items, top, least, head, block_items=10)
    assert _rows(got.select(*every.columns)) == _rows(every)


@pytest.mark.parametrize(("top_n", "head", "spread"), [(5, 3, True), (50, 32, True), (50, 2, False), (100_000, 4, True)])
def test_recommendations_are_those_of_all_pairs(spark, top_n, head, spread):
    items = _items(spark, top_n)
    affinity = _affinity(items, spread)
    every = recommend.track_recommendations(recommend.score_pairs(items), affinity, top_n=top_n)
    got = top_pairs.top_recommendations(items, affinity, top_n=top_n, head=head, block_items=10)
    assert _rows(got.select(*every.columns)) == _rows(every)


def test_empty_items(spark):
    items = _items(spark, 1).limit(0)
    assert top_pairs.top_partners(items, 5).count() == 0
    assert top_pairs.top_recommendations(items, _affinity(items)).count() == 0


def test_fewer_pairs_are_made(spark, monkeypatch):
    items = _items(spark, 2, users=2, sessions=400, tracks=600)
    made = []
    plain = top_pairs._paired

    def counted(*args):
        out = plain(*args)
        made.append(out.agg(F.sum("sessions_together")).first()[0] or 0)
        return out

    monkeypatch.setattr(top_pairs, "_paired", counted)
    every = recommend.session_pairs(items).count()
    top_pairs.top_recommendations(items, _affinity(items)).count()
    assert sum(made) < every / 2
    made.clear()
    top_pairs.top_partners(items, 3, min_sessions=2).count()
    assert sum(made) < every
