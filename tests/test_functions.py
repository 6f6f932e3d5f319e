"""Column functions against known values."""

import uuid

import pytest
from pyspark.sql import functions as F

from earshot.functions import dates, numeric, text


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], kinds).select(column.alias("r")).first().r


def ts(text_value):
    return F.lit(text_value).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "part, a, b, want",
    [
        ("minute", "2024-01-01 10:59:59", "2024-01-01 11:00:00", 1),
        ("minute", "2024-01-01 10:00:30", "2024-01-01 11:01:00", 61),
        ("hour", "2024-01-01 10:59:59", "2024-01-01 11:00:00", 1),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("week", "2024-01-07 23:00:00", "2024-01-08 01:00:00", 1),
        ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
        ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        ("second", "2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 1),
        ("minute", "2024-01-01 11:00:00", "2024-01-01 10:59:59", -1),
    ],
)
def test_boundaries_are_counted(spark, part, a, b, want):
    assert one(spark, dates.datediff_boundary(part, ts(a), ts(b))) == want


def test_spine_excludes_its_end(spark):
    bounds = spark.sql("SELECT timestamp_ntz'2018-01-01' AS lo, timestamp_ntz'2018-01-10' AS hi")
    days = [r.date_day.day for r in dates.date_spine(bounds, "day", "lo", "hi").orderBy("date_day").collect()]
    assert days == list(range(1, 10))
    empty = spark.sql("SELECT timestamp_ntz'2018-01-01' AS lo, timestamp_ntz'2018-01-01' AS hi")
    assert dates.date_spine(empty, "day", "lo", "hi").count() == 0


def test_series_and_ranges(spark):
    assert [r.generated_number for r in dates.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        dates.generate_series(spark, 0)
    assert dates.partition_range("20240228,20240301") == ["20240228", "20240229", "20240301"]
    with pytest.raises(ValueError):
        dates.dates_in_range("20240301", "20240228")


@pytest.mark.parametrize("raw", ["2025-12-12T23:08:11Z", "2025-12-12T23:08:11+00:00", "2025-12-12T23:08:11.000Z"])
def test_iso_times(spark, raw):
    assert str(one(spark, dates.try_cast_ts("s"), s=("string", raw))) == "2025-12-12 23:08:11"


def test_bad_time_is_null_or_fallback(spark):
    assert one(spark, dates.try_cast_ts("s"), s=("string", "x")) is None
    fallback = F.lit("2024-01-01").cast("timestamp")
    assert one(spark, dates.parse_iso_ts("s", fallback).cast("string"), s=("string", "x")) == "2024-01-01 00:00:00"


@pytest.mark.parametrize(
    "a, b, c, only, everything",
    [
        ("a", "b", "c", "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("a", None, "c", "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        (None, None, "c", "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        (None, None, None, "f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ],
)
def test_surrogate_keys(spark, a, b, c, only, everything):
    row = dict(a=("string", a), b=("string", b), c=("string", c))
    assert one(spark, text.generate_surrogate_key(["a"]), **row) == only
    assert one(spark, text.generate_surrogate_key(["a", "b", "c"]), **row) == everything


def test_uuid5_equals_python(spark):
    for name in ("u_t_2025-12-12T23:08:11Z", "", "é_ß", "x" * 300):
        assert one(spark, text.uuid5("s"), s=("string", name)) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("www.example.co.uk?utm_source=a&utm_medium=b", "www.example.co.uk", ""),
        ("http://example.com/2018/01/tips/", "example.com", "2018/01/tips/"),
        ("https://www.example.com/2018/01/01/blog", "www.example.com", "2018/01/01/blog"),
        ("android-app://m.example.com/", "m.example.com", None),
        ("http://example.com/tips/?utm_source=a", "example.com", "tips/"),
        ("https://http://example.com:8080/x?u=http://other.org/", "example.com:8080", None),
        ("example.com", "example.com", None),
        ("https:///x", "", None),
        ("", "", None),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, host, path):
    assert one(spark, text.get_url_host("u"), u=("string", url)) == host
    if path is not None:
        assert one(spark, text.get_url_path("u"), u=("string", url)) == path


def test_url_parameter(spark):
    url = "http://example.com/milky?utm_medium=organic&utm_source=site"
    assert one(spark, text.get_url_parameter("u", "utm_medium"), u=("string", url)) == "organic"
    assert one(spark, text.get_url_parameter("u", "utm_source"), u=("string", url)) == "site"
    assert one(spark, text.get_url_parameter("u", "utm_term"), u=("string", url)) is None


@pytest.mark.parametrize(
    "raw, slug", [("!Hell0 world-hi", "hell0_world_hi"), ("0Hell0 world-hi", "_0hell0_world_hi"), ("a  - b", "a_b"), ("-x ", "_x_")]
)
def test_slugs(spark, raw, slug):
    assert one(spark, text.slugify("s"), s=("string", raw)) == slug
    assert text.slugify_name(raw) == slug


def test_split_part_edges(spark):
    for n, want in ((1, "a"), (3, "c"), (-1, "c"), (-3, "a"), (4, "")):
        assert one(spark, text.split_part("s", "|", n), s=("string", "a|b|c")) == want


@pytest.mark.parametrize("amount, bucket", [(190000, 0), (290000, 1), (320000, 2), (399999.99, 2), (400000, 3), (510000, 4), (610000, 5)])
def test_width_bucket(spark, amount, bucket):
    assert one(spark, numeric.width_bucket("a", 200000.0, 600000.0, 4), a=("double", float(amount))) == bucket


def test_haversine(spark):
    spots = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(spark, numeric.haversine_distance(*spots))) == 267
    assert round(one(spark, numeric.haversine_distance(*spots, unit="km"))) == 430
    with pytest.raises(ValueError):
        numeric.haversine_distance(*spots, unit="ly")


def test_null_counts_as_zero(spark):
    row = dict(a=("int", 4), b=("int", None), c=("int", 3))
    assert one(spark, numeric.safe_add(["a", "b", "c"]), **row) == 7
    assert one(spark, numeric.safe_subtract(["a", "b", "c"]), **row) == 1


def test_division(spark):
    assert one(spark, numeric.safe_divide(F.lit(6), F.lit(0))) is None
    assert one(spark, numeric.safe_divide(F.lit(10), F.lit(5))) == 2


def test_averages_end_half_up_as_whole_numbers(spark):
    assert one(spark, numeric.whole_number(F.lit(1.5))) == 2
    assert one(spark, numeric.whole_number(F.lit(2.5))) == 3
    assert one(spark, numeric.whole_number(F.lit(2.494))) == 2
    assert one(spark, numeric.whole_number(F.lit(2.495))) == 3


def test_score_is_rounded_before_the_factor(spark):
    # 0.7 * 0.333 + 0.3 * 0.5 = 0.3831 -> 0.383 -> 38.3
    assert one(spark, numeric.blended_score(F.lit(0.333), F.lit(50.0))) == 38.3
    # half-up at exactly 0.xxx5: 0.7 * 0.005 = 0.0035 -> 0.004
    assert one(spark, numeric.blended_score(F.lit(0.005), F.lit(0.0))) == 0.4


@pytest.mark.parametrize(
    "co, aff, n, want",
    [
        (0.8, 80.0, 3, "Frequently played together (3 sessions), artist is highly preferred"),
        (0.5, 50.0, 2, "Often played together (2 sessions), artist is well-liked"),
        (0.49, 49.9, 1, "Sometimes played together (1 sessions)"),
    ],
)
def test_reasons(spark, co, aff, n, want):
    assert one(spark, text.reasoning_text(F.lit(co), F.lit(aff), F.lit(n))) == want
