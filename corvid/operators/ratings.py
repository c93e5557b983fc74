"""Two-level aggregation: users -> mean rating -> histogram of users by mean
rating truncated to one decimal.

Both levels are plain ``groupBy`` aggregates, so each gets a partial
(map-side) aggregate before its shuffle: a user holding a third of all rows
is combined inside the map tasks, and the second level only shuffles one
row per bucket per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.columns import trunc_to_int


def positive_ratings(ratings: DataFrame, rating: str = "rating") -> DataFrame:
    """Keep rows with ``rating > 0``; NULL ratings (unparsed lines) fail it."""
    return ratings.where(F.col(rating) > 0)


def user_avg_rating(ratings: DataFrame, user: str = "user",
                    rating: str = "rating") -> DataFrame:
    """``(user_id, avg_rating)`` over positive ratings; users that do not
    parse fall together in the NULL user group."""
    return (positive_ratings(ratings, rating)
            .groupBy(F.col(user).alias("user_id"))
            .agg(F.avg(rating).alias("avg_rating")))


# The SQL form: mean as sum * 10 / count over the raw rating column, so
# lines with a missing rating give a NULL bucket counted as 0, and ratings
# of zero or below are kept.
_HISTOGRAM_SQL = """
SELECT CAST(bucket AS DOUBLE) / 10 AS rating, count(bucket) AS n
FROM (
  SELECT CASE WHEN isnan(x) THEN 0 WHEN x >= 2147483647 THEN 2147483647
              WHEN x <= -2147483648 THEN -2147483648 ELSE try_cast(x AS INT) END AS bucket
  FROM (
    SELECT sum(try_cast(r AS DOUBLE)) * 10 / nullif(count(r), 0) AS x
    FROM (SELECT {user} AS u, {rating} AS r FROM {ratings})
    GROUP BY u
  )
)
GROUP BY bucket
ORDER BY rating
"""


def rating_histogram(ratings: DataFrame, mode: str = "avg", user: str = "user",
                     rating: str = "rating") -> DataFrame:
    """Histogram ``(rating DOUBLE, n LONG)`` ordered by rating.

    ``avg``: positive ratings only, bucket = int(avg * 10) per user.
    ``sql``: no row filter, bucket = int(sum * 10 / count) per user, issued
    as a SQL statement over the DataFrame; non-numeric ratings are left out
    of the sum but still counted.
    Both truncate toward zero like a Java ``(int)`` cast (NaN counts as 0,
    values out of range saturate); empty buckets are not emitted.
    """
    if mode == "avg":
        buckets = (user_avg_rating(ratings, user, rating)
                   .select(trunc_to_int(F.col("avg_rating") * 10).alias("bucket")))
        return (buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                .select((F.col("bucket").cast("double") / 10).alias("rating"), "n")
                .orderBy("rating"))
    if mode == "sql":
        spark = ratings.sparkSession
        q = _HISTOGRAM_SQL.format(user=f"`{user}`", rating=f"`{rating}`",
                                  ratings="{ratings}")
        return spark.sql(q, ratings=ratings)
    raise ValueError(f"mode must be 'avg' or 'sql', not {mode!r}")
