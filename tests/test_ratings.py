"""Rating histogram: shipped fixture, discriminating edge cases, property."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvid.operators.ratings import rating_histogram, user_avg_rating
from corvid.sources import parse_ratings
from tests.conftest import lines_df

# Shipped ratings fixture (header lines are movie ids).
SMALL = [
    "32:", "15,4,2022-08-05", "12,3,2022-08-05", "10,1,2022-08-05",
    "45:", "10,2,2022-08-05", "11,4,2022-08-05", "15,4,2022-08-05",
    "13,5,2022-08-05", "12,2,2022-08-05",
    "67:", "12,3,2022-08-05", "15,4,2022-08-05", "10,2,2022-08-05",
    "13,2,2022-08-05", "11,1,2022-08-05", "14,2,2022-08-05", "16,2,2022-08-05",
]
GOLDEN = [(1.6, 1), (2.0, 2), (2.5, 1), (2.6, 1), (3.5, 1), (4.0, 1)]


def hist(spark, lines, mode):
    parsed = parse_ratings(lines_df(spark, lines), "typed" if mode == "avg" else "raw")
    return [tuple(r) for r in rating_histogram(parsed, mode=mode).collect()]


@pytest.mark.parametrize("mode", ["avg", "sql"])
def test_small_golden(spark, mode):
    assert hist(spark, SMALL, mode) == GOLDEN


def test_result_schema(spark):
    df = rating_histogram(parse_ratings(lines_df(spark, SMALL)), mode="avg")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == \
        [("rating", "double"), ("n", "bigint")]


def test_zero_rating_separates_modes(spark):
    lines = ["7,0,d", "7,4,d"]
    assert hist(spark, lines, "avg") == [(4.0, 1)]
    assert hist(spark, lines, "sql") == [(2.0, 1)]


def test_user_type_separates_modes(spark):
    lines = ["012,3,d", "12,4,d"]
    assert hist(spark, lines, "avg") == [(3.5, 1)]
    assert hist(spark, lines, "sql") == [(3.0, 1), (4.0, 1)]


def test_short_line(spark):
    assert hist(spark, ["7"], "avg") == []
    assert hist(spark, ["7"], "sql") == [(None, 0)]


def test_truncation_not_rounding(spark):
    lines = [f"3,{r},d" for r in (5, 4, 4, 4, 4, 4, 4, 4)]
    assert hist(spark, lines, "avg") == [(4.1, 1)]
    assert hist(spark, lines, "sql") == [(4.1, 1)]


def test_malformed_rating_is_counted_not_summed_in_sql_mode(spark):
    # user 5: ratings 4 and 'x' -> sum 4, count 2 -> 2.0
    assert hist(spark, ["5,4,d", "5,x,d"], "sql") == [(2.0, 1)]
    # the typed load turns 'x' into NULL, which the rating > 0 filter drops
    assert hist(spark, ["5,4,d", "5,x,d"], "avg") == [(4.0, 1)]


def test_unparsable_user_groups_as_null(spark):
    df = user_avg_rating(parse_ratings(lines_df(spark, ["a,2,d", "b,4,d", "1,5,d"])))
    got = sorted((r.user_id is None, r.avg_rating) for r in df.collect())
    assert got == [(False, 5.0), (True, 3.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 5)), min_size=1, max_size=40))
def test_histogram_counts_all_users(spark, rows):
    lines = [f"{u},{r},d" for u, r in rows]
    by_user = {}
    for u, r in rows:
        by_user.setdefault(u, []).append(r)
    got = hist(spark, lines, "avg")
    expect = {}
    for rs in by_user.values():
        pos = [r for r in rs if r > 0]
        if pos:
            b = int(sum(pos) / len(pos) * 10)
            expect[b / 10] = expect.get(b / 10, 0) + 1
    assert got == sorted(expect.items())
    sql = hist(spark, lines, "sql")
    assert sum(n for _, n in sql) == len(by_user)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_buckets_are_java_int_casts(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = ["1,NaN,d", "2,1e300,d", "3,4,d", "4,Infinity,d"]
        want = [(0.0, 1), (4.0, 1), (214748364.7, 2)]
        for mode in ("avg", "sql"):
            df = parse_ratings(lines_df(spark, lines), "typed" if mode == "avg" else "raw")
            assert [tuple(r) for r in rating_histogram(df, mode).collect()] == want
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
