"""Data tests. Each returns the rows that break its rule; :func:`run_tests` turns them into results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import dateadd
from .ordering import natural_bucket, neighbours, neighbours_in_buckets
from .reshape import except_sets


def _broken(rule: Column) -> Column:
    """True where the rule is false; a rule that is null passes."""
    return ~rule


def unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
    return counted.filter(_broken(F.col("value_field").isin(*values)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.select(F.col(column).alias("value_field")).distinct().filter(F.col("value_field").isin(*values))


def relationships(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: str = "true",
    to_condition: str = "true",
) -> DataFrame:
    """Child keys the parent lacks, one row per child row."""
    left = child.filter(F.col(column).isNotNull()).filter(from_condition).select(F.col(column).alias("id"))
    right = parent.filter(F.col(field).isNotNull()).filter(to_condition).select(F.col(field).alias("id")).distinct()
    return left.join(right, "id", "left_anti")


def aggregated_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column and null, for many columns in one scan."""
    flags = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    return df.select(F.explode(F.array_compact(F.array(*flags))).alias("column_name"))


def aggregated_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated values of many columns, found in one scan with grouping sets."""
    sets = [[F.col(c)] for c in columns]
    grouped = df.groupingSets(sets, *columns).agg(
        *[F.grouping(c).alias(f"_g_{c}") for c in columns], F.count("*").alias("n_records")
    )
    name = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")) for c in columns])
    out = grouped.select(name.alias("column_name"), value.alias("unique_field"), "n_records")
    return out.filter((F.col("n_records") > 1) & F.col("unique_field").isNotNull())


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return df.filter(_out_of_range(F.col(column), min_value, max_value, inclusive))


def _out_of_range(value: Column, low, high, inclusive: bool) -> Column:
    broken = F.lit(False)
    if low is not None:
        broken = broken | _broken(value >= low if inclusive else value > low)
    if high is not None:
        broken = broken | _broken(value <= high if inclusive else value < high)
    return broken


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Fails when no value is present; with groups, one row per group that has none.

    (A form that looks only at rows with a value, as some do, could never
    report a group.)
    """
    return df.groupBy(*group_by).agg(F.count(column).alias("filler_column")).filter("filler_column = 0")


def _by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both frames with how often each side has them (``_a``, ``_b``), by one aggregate."""
    both = a.select("*", F.lit(1).alias("_left")).unionAll(b.select("*", F.lit(0).alias("_left")))
    return both.groupBy(*a.columns).agg(F.sum("_left").alias("_a"), F.sum(1 - F.col("_left")).alias("_b"))


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """Values whose row counts differ between two tables."""

    counted = _by_side(a.select(F.col(column).alias("value_field")), b.select(F.col(field).alias("value_field")))
    sides = F.filter(F.array("_a", "_b"), lambda n: n > 0)
    return counted.filter("_a <> _b").select("value_field", F.explode(sides).alias("num_rows"))


def _count_pairs(a: DataFrame, b: DataFrame, group_by: Sequence[str], name_a: str, name_b: str) -> DataFrame:
    def counted(df: DataFrame, side: str, name: str) -> DataFrame:
        out = df.groupBy(*group_by).agg(F.count("*").alias(name))
        return out.select(*[F.col(g).alias(f"{g}_{side}") for g in group_by], name)

    left, right = counted(a, "a", name_a), counted(b, "b", name_b)
    if not group_by:  # one row each
        return left.withColumn(name_b, right.scalar())
    return left.join(right, [F.col(f"{g}_a") == F.col(f"{g}_b") for g in group_by], "full")


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side; failures are the sum of ``diff_count``."""
    both = _count_pairs(a, b, group_by, "count_a", "count_b")
    return both.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


EQUAL_ROWCOUNT_FAILURES = "sum(coalesce(diff_count, 0))"


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side; failures are the sum of ``row_count_delta``."""
    both = _count_pairs(a, b, group_by, "count_our_model", "count_comparison_model")
    more = F.col("count_our_model") - F.col("count_comparison_model")
    return both.withColumn("row_count_delta", F.when(more > 0, more).when(more == 0, 1).otherwise(0))


FEWER_ROWS_FAILURES = "sum(coalesce(row_count_delta, 0))"


def equality(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows only one of the tables has, labelled by side."""
    columns = list(columns or a.columns)
    counted = _by_side(a.select(*columns), b.select(*columns)).filter("_a = 0 or _b = 0")
    return counted.select(F.when(F.col("_a") > 0, "a_minus_b").otherwise("b_minus_a").alias("which_diff"), *columns)


EQUALITY_FAILURES = (
    "count(*) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)"
)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows where the expression (applied to ``column`` if given) is false."""
    return df.filter(_broken(F.expr(f"{column or ''} {expression}")))


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty, or that clash with the next one of their group."""
    meets = {
        "not_allowed": lambda a, b: a == b,
        "allowed": lambda a, b: a <= b,
        "required": lambda a, b: a < b,
    }
    if gaps not in meets:
        raise ValueError("gaps must be 'allowed', 'not_allowed' or 'required'")
    part = [F.col(partition_by).alias("partition_by_col")] if partition_by else []
    ranges = df.select(*part, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    order = [F.col("lower_bound").asc_nulls_last(), F.col("upper_bound").asc_nulls_last()]
    shifted = {"next_lower_bound": F.col("lower_bound"), "_has_next": F.lit(True)}
    group, bucket = ["partition_by_col"] if partition_by else [], natural_bucket(ranges, "lower_bound")
    if bucket is None:
        seen = neighbours(ranges, order, shifted, group, offset=1, unique=False)
    else:
        seen = neighbours_in_buckets(ranges, [F.col("lower_bound"), F.col("upper_bound")], bucket, shifted, group, offset=1)
    lo, hi = F.col("lower_bound"), F.col("upper_bound")
    filled = F.coalesce(lo <= hi if zero_length_range_allowed else lo < hi, F.lit(False))
    apart = F.coalesce(meets[gaps](hi, F.col("next_lower_bound")), F.col("_has_next").isNull())
    return seen.filter(~(filled & apart)).drop("_has_next")


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_by).agg(F.countDistinct(column).alias("filler_column")).filter("filler_column = 1")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    value = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.select(value.alias(column)).filter(F.col(column) == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = F.count(column) / F.count("*")
    out = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return out.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of: Column | None = None,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest row is older than the interval."""
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    kind = "date" if ignore_time_component else "timestamp_ntz"
    newest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    threshold = dateadd(datepart, -interval, now).cast(kind)
    return newest.withColumn("threshold", threshold).filter(F.col("most_recent") < F.col("threshold"))


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: Sequence[str] = ()
) -> DataFrame:
    """Values that are not their predecessor plus the interval; the first passes."""
    previous = f"previous_{column}"
    rows = df.select(*group_by, column)
    bucket = natural_bucket(rows, column)
    if bucket is None:
        seen = neighbours(rows, [F.col(column).asc_nulls_last()], {previous: F.col(column)}, list(group_by), unique=False)
    else:
        seen = neighbours_in_buckets(rows, [F.col(column)], bucket, {previous: F.col(column)}, list(group_by))
    due = dateadd(datepart, interval, F.col(previous)) if datepart else F.col(previous) + interval
    return seen.filter(_broken(F.col(column) == due))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.filter(F.col(actual) != F.col(expected))


def columns_match_set(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column names found on one side only."""
    have, want = {c.lower() for c in df.columns}, {c.lower() for c in columns}
    rows = [(c, "missing") for c in sorted(want - have)] + [(c, "unexpected") for c in sorted(have - want)]
    return df.sparkSession.createDataFrame(rows, "column_name string, problem string")


def contract_check(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Columns whose name or type is not as declared."""
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name.lower(): f.dataType.simpleString() for f in declared.fields}
    rows = [(c, want.get(c), have.get(c)) for c in sorted(have.keys() | want.keys()) if have.get(c) != want.get(c)]
    return df.sparkSession.createDataFrame(rows, "column_name string, declared_type string, actual_type string")


def unit_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows (with their multiplicity) that only one side has, labelled."""
    counted = _by_side(actual, expected.select(*actual.columns)).filter("_a <> _b")
    side = F.when(F.col("_a") > F.col("_b"), "actual").otherwise("expected")
    # A row for each time that one side has it more often than the other.
    times = F.explode(F.sequence(F.lit(1), F.abs(F.col("_a") - F.col("_b"))))
    return counted.select(*actual.columns, side.alias("actual_or_expected"), times.alias("_n")).drop("_n")


@dataclass
class DataTest:
    """Failing rows and how they are judged."""

    name: str
    failing: DataFrame
    fail_calc: str = "count(*)"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    limit: int | None = None


def run_tests(tests: Sequence[DataTest], store_failures: str | None = None) -> DataFrame:
    """One row per test: failures, should_warn, should_error, status.

    With ``store_failures`` the failing rows of each test are written under
    that folder first and counted from there.
    """
    rows = []
    for test in tests:
        failing = test.failing if test.limit is None else test.failing.limit(test.limit)
        if store_failures is not None:
            path = f"{store_failures}/{test.name}"
            failing.write.mode("overwrite").parquet(path)
            failing = failing.sparkSession.read.schema(failing.schema).parquet(path)
        rows.append(
            failing.agg(F.coalesce(F.expr(test.fail_calc), F.lit(0)).cast("long").alias("failures")).select(
                F.lit(test.name).alias("test_name"),
                "failures",
                F.expr(f"failures {test.warn_if}").alias("should_warn"),
                F.expr(f"failures {test.error_if}").alias("should_error"),
            )
        )
    out = reduce(DataFrame.unionAll, rows)
    status = F.when(F.col("should_error"), "fail").when(F.col("should_warn"), "warn").otherwise("pass")
    return out.withColumn("status", status)


def aggregated_test_result(failing: DataFrame) -> DataFrame:
    """Failures per column of an aggregated test."""
    out = failing.groupBy("column_name").agg(F.count("*").alias("failures"))
    return out.withColumns({"should_warn": F.col("failures") > 0, "should_error": F.col("failures") > 0})


def test_suite(
    df: DataFrame,
    unique_columns: Sequence[str] = (),
    not_null_columns: Sequence[str] = (),
    ranges: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """Declared column tests of a table in two scans however many there are.

    Null and range rules are counted side by side in one aggregate; all
    uniqueness rules share one grouping-sets pass.
    """
    checks = {f"not_null_{c}": F.col(c).isNull() for c in not_null_columns}
    checks |= {f"accepted_range_{c}": _out_of_range(F.col(c), lo, hi, True) for c, (lo, hi) in (ranges or {}).items()}
    parts = []
    if checks:
        one = df.agg(*[F.count_if(rule).alias(name) for name, rule in checks.items()])
        parts.append(one.unpivot([], list(checks), "test_name", "failures"))
    if unique_columns:
        repeated = aggregated_unique(df, unique_columns).groupBy("column_name").agg(F.count("*").alias("failures"))
        names = df.sparkSession.createDataFrame([(c,) for c in unique_columns], "column_name string")
        parts.append(
            names.join(repeated, "column_name", "left").select(
                F.concat(F.lit("unique_"), "column_name").alias("test_name"),
                F.coalesce("failures", F.lit(0)).alias("failures"),
            )
        )
    out = reduce(DataFrame.unionAll, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# pytest must not take the operator for a test case.
test_suite.__test__ = False

# The declared column tests of the tables.
SILVER_RULES = dict(
    unique_columns=["event_id"],
    not_null_columns=[
        "event_id", "user_id", "event_type", "track_id", "track_name", "artist_name", "duration_ms", "played_at",
        "processed_at",
    ],
    ranges={"duration_ms": (1, 600_000)},
)
GOLD_RULES = {
    "daily_user_stats": dict(
        not_null_columns=[
            "date", "user_id", "total_plays", "total_listening_time_ms", "unique_tracks", "unique_artists",
            "avg_track_duration_ms",
        ]
    ),
    "top_tracks": dict(
        unique_columns=["track_id", "rank"],
        not_null_columns=[
            "track_id", "track_name", "artist_name", "total_plays", "total_listening_time_ms", "first_played_at",
            "last_played_at", "rank",
        ],
    ),
    "top_artists": dict(
        unique_columns=["artist_name", "rank"],
        not_null_columns=[
            "artist_name", "total_plays", "total_listening_time_ms", "unique_tracks", "first_played_at",
            "last_played_at", "rank",
        ],
    ),
    "device_usage": dict(
        unique_columns=["device_type"],
        not_null_columns=[
            "device_type", "total_plays", "total_listening_time_ms", "play_percentage", "avg_track_duration_ms",
        ],
    ),
}


def silver_test_suite(silver: DataFrame) -> DataFrame:
    return test_suite(silver, **SILVER_RULES)


def gold_test_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [test_suite(df, **GOLD_RULES[n]).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)
