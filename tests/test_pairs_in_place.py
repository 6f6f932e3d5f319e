"""Pairs made where the user is: the rows of the shuffled form, and no pair is moved."""

import random

import pytest
from pyspark.sql import functions as F

from earshot.operators import recommend, top_pairs

SCHEMA = "user_id string, session_id long, track_id string, track_name string, artist_name string, plays long"


def _items(spark, seed=1):
    """Users of all sizes, tracks of two names, and nulls in every key."""
    rng = random.Random(seed)
    rows = set()
    for user in range(6):
        for session in range(4 + 4 * user):
            for _ in range(rng.choice([1, 3, 9])):
                t = rng.randrange(20)
                rows.add((f"u{user}", session, f"t{t:02d}", f"T{t}-{rng.randrange(2)}", f"A{t % 4}", 1))
    rows |= {(None, 1, "t01", "T", "A1", 1), (None, 1, "t02", "T", "A1", 1), ("u1", None, "t01", "T", "A1", 1), ("u1", None, "t02", "T", "A1", 1)}
    rows |= {("u1", 1, None, "T", None, 1), ("u1", 1, "t50", None, None, 1), ("u1", 1, "t51", None, None, 1)}
    return spark.createDataFrame(list(rows), SCHEMA)


def _affinity(items):
    liked = items.filter("artist_name <> 'A3'").select("user_id", "artist_name").distinct()
    return liked.withColumn("affinity_score", (F.pmod(F.hash("user_id", "artist_name"), F.lit(1000)) / 10).cast("double"))


def _rows(df, like):
    return sorted((tuple(r) for r in df.select(*like.columns).collect()), key=repr)


@pytest.mark.parametrize("light", [0, 60, 20_000])
@pytest.mark.parametrize(("least", "symmetric"), [(1, False), (2, True)])
def test_scores_are_those_of_shuffled_pairs(spark, light, least, symmetric):
    items = _items(spark)
    want = recommend._score_shuffled(items, least, symmetric)
    got = recommend.score_pairs(items, least, symmetric, light=light)
    assert got.columns == want.columns and _rows(got, want) == _rows(want, want)


@pytest.mark.parametrize("light", [0, 60, 20_000])
def test_counts_and_blends_are_those_of_shuffled_pairs(spark, light):
    items, by = _items(spark), ("user_id", "track_a_id", "track_b_id")
    want = recommend.session_pairs(items).groupBy(*by).agg(F.count("*").alias("sessions_together"))
    assert _rows(recommend.pair_counts(items, by, light), want) == _rows(want, want)
    affinity = _affinity(items)
    want = recommend.score_candidates(recommend._score_shuffled(items), affinity)
    got = recommend.scored_pairs(items, affinity, light=light)
    assert got.columns == want.columns and _rows(got, want) == _rows(want, want)
    best = recommend.best_per_user(want, 7)
    assert _rows(top_pairs.top_recommendations(items, affinity, top_n=7, light=light), best) == _rows(best, best)


def test_pairs_of_everyday_users_are_not_moved(spark):
    items = _items(spark)
    plans = [recommend.score_pairs(items), recommend.scored_pairs(items, _affinity(items)), recommend.pair_counts(items)]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "Exchange" in line and "track_a_id" in line]
        assert not moved, plan


def test_tasks_follow_the_load(spark, monkeypatch):
    """Ten times the users, ten times the tasks: a task keeps its number of pairs."""
    monkeypatch.setattr(recommend, "TASK_PAIRS", 50)
    items = _items(spark).filter("user_id is not null")
    many = items.crossJoin(spark.range(10)).withColumn("user_id", F.concat("user_id", F.lit("-"), "id")).drop("id")
    one, ten = recommend.by_load(items)[2], recommend.by_load(many)[2]
    assert 9 * one <= ten <= 10 * one
