"""Bindings of the driver tables to the three data models.

Every binding reads whole tables (no id subsets, no row caps); the parquet
scans only read the columns named here.

* matrices: lineitem as an order x part matrix of quantities. ``M`` holds
  the returned lines (``l_returnflag = 'R'``), ``N`` all other lines, so
  together they use every line once. A part ordered twice in one order
  gives a repeated cell, which the addition resolves with ``sum``.
* graph: orders as directed edges customer -> order over one id space
  (customer 5 and order 5 are one vertex); every customer also has a line of
  its own, and every supplier a bare line with the id ``-(s_suppkey + 1)``,
  which no edge touches: these are the isolated vertices.
* ratings: lineitem as (user = part, rating = whole quantity mod 6), so
  ratings 0..5 occur and zero ratings separate the two histogram modes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- matrices


def _lineitem_cells(spark, sf_dir, returned: bool, j: str = "l_partkey") -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cond = F.col("l_returnflag").eqNullSafe("R")  # a null flag is not 'R'
    return (li.where(cond if returned else ~cond)
            .select(F.col("l_orderkey").alias("i"), F.col(j).cast("long").alias("j"),
                    F.col("l_quantity").alias("v")))


def matrix_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_cells(spark, sf_dir, True)


def matrix_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_cells(spark, sf_dir, False)


def all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lineitem as an order x part matrix of quantities."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("i"), F.col("l_partkey").cast("long").alias("j"),
        F.col("l_quantity").alias("v"))


def cell_lines(cells: DataFrame) -> DataFrame:
    """Cells as ``i,j,v`` text lines (the matrix file layout)."""
    return cells.select(F.concat_ws(",", F.col("i").cast("string"), F.col("j").cast("string"),
                                    F.format_string("%.3f", "v")).alias("value"))


def order_line_cells(spark: SparkSession, sf_dir: str, value: str = "l_quantity",
                     returned: bool | None = None) -> DataFrame:
    """All lineitem (or the returned, or the other lines) as an order x
    line-number matrix of a column, by default the quantity."""
    li = table(spark, sf_dir, "lineitem")
    if returned is not None:
        cond = F.col("l_returnflag").eqNullSafe("R")
        li = li.where(cond if returned else ~cond)
    return li.select(F.col("l_orderkey").alias("i"), F.col("l_linenumber").cast("long").alias("j"),
                     F.col(value).cast("double").alias("v"))


# ---------------------------------------------------------------- graph


def order_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, adj)`` rows: one per order (customer -> order), and one without
    neighbours per customer and per supplier."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.array(F.col("o_orderkey")).alias("adj"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.array().cast("array<bigint>").alias("adj"))
    suppliers = table(spark, sf_dir, "supplier").select(
        _supplier_id().alias("id"), F.array().cast("array<bigint>").alias("adj"))
    return orders.unionByName(customers).unionByName(suppliers)


def _supplier_id() -> F.Column:
    return -(F.col("s_suppkey").cast("long") + 1)


def order_adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order graph as adjacency text: ``customer,order`` per order and a
    bare line per customer and per supplier."""
    orders = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", F.col("o_custkey").cast("string"),
                    F.col("o_orderkey").cast("string")).alias("value"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("value"))
    suppliers = table(spark, sf_dir, "supplier").select(
        _supplier_id().cast("string").alias("value"))
    return orders.unionByName(customers).unionByName(suppliers)


def scanned_adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_adjacency_lines`` as scanner-style readers meet them: every
    order's line goes on with its priority, which is no integer, and another
    id, which a reader that stops at the first bad token never sees."""
    orders = table(spark, sf_dir, "orders").select(F.concat_ws(
        ",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"),
        F.coalesce("o_orderpriority", F.lit("none")), F.col("o_custkey").cast("string"))
        .alias("value"))
    bare = order_adjacency_lines(spark, sf_dir).where(~F.col("value").contains(","))
    return orders.unionByName(bare)


def lineitem_adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``order,part,supplier`` (an id and two neighbours), one
    per lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws(",", "l_orderkey", "l_partkey", "l_suppkey").alias("value"))


# ---------------------------------------------------------------- ratings


def _rating() -> F.Column:
    return (F.col("l_quantity").cast("int") % 6).cast("double")


def part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user BIGINT, rating DOUBLE)`` over all lineitem rows."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("user"), _rating().alias("rating"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating text as the ratings files lay it out: ``user,rating,date``
    lines, plus an ``order:`` header line for every first line of an order."""
    li = table(spark, sf_dir, "lineitem")
    body = li.select(F.concat_ws(
        ",", F.col("l_partkey").cast("string"),
        (F.col("l_quantity").cast("int") % 6).cast("string"),
        F.to_date("l_shipdate").cast("string")).alias("value"))
    headers = li.where(F.col("l_linenumber") == 1).select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(":")).alias("value"))
    return body.unionByName(headers)


def broken_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rating lines, one for every second, third and fourth line of an
    order: no rating, a rating that is no number, a user that is none."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber").between(2, 4))
    part = F.col("l_partkey").cast("string")
    return li.select(F.when(F.col("l_linenumber") == 2, part)
                     .when(F.col("l_linenumber") == 3, F.concat(part, F.lit(",many,")))
                     .otherwise(F.concat(F.lit("u"), part, F.lit(",3,"))).alias("value"))
