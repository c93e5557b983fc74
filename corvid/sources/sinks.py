"""Text sinks. Results are written by the executors, part file per task;
nothing passes through the driver.

A result that was ordered is range-partitioned, so its part files, read by
name one after the other, hold it in order, and no task holds all of it.
``read_in_order`` reads them back with the place of every line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, sep: str = "\t",
                    mode: str = "errorifexists") -> None:
    """``key<sep>value`` lines without header (tab by default)."""
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def write_lines(df: DataFrame, path: str, sep: str = ",",
                mode: str = "errorifexists") -> None:
    """Render every row as one text line of its columns joined by ``sep``."""
    rendered = df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])
                         .alias("value"))
    rendered.write.mode(mode).text(path)


def read_in_order(spark: SparkSession, path: str, schema, sep: str = "\t") -> DataFrame:
    """The lines of a folder that a sink wrote, parsed with ``schema``, and
    ``pos``: the place (from 0) of each line when the part files are read by
    name one after the other. No part file passes through one task alone: lines
    are numbered within the splits of the files, and the splits' sizes (one
    row for each) give where each begins."""
    scan = spark.read.option("sep", sep).csv(path, schema=schema)
    split = [F.col("_metadata.file_name").alias("_file"),
             F.col("_metadata.file_block_start").alias("_start")]
    # increasing within a split, whatever partition reads it
    rows = scan.select("*", *split, F.monotonically_increasing_id().alias("_line"))
    inside = rows.withColumn("_in", F.row_number().over(
        Window.partitionBy("_file", "_start").orderBy("_line")) - 1)
    sizes = rows.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_start").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    begins = sizes.select("_file", "_start", before.alias("_before"))
    return (inside.join(begins, ["_file", "_start"])
            .select(*scan.columns, (F.col("_before") + F.col("_in")).alias("pos")))
