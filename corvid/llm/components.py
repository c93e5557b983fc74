"""Connected components of an edge table. Edges hang every node below smaller
ones; a round

1. moves each edge from the node it hangs on to the smallest one above that
   (paths halve), then
2. brings all edges of a hanging node together and makes what hangs together in
   a task a star below its smallest node (``forest``), before the shuffle and
   after it.

Since every task has at most one edge for each hanging node after ``forest``,
no shuffle by hanging node is skewed, whatever the size of a group, and no
group is ever gathered in one task. Nodes with very many others below (at most
``MOST`` can be such) meet their edges as a broadcast. Edges are written to the
shared folder after every round; a round is three short jobs, and what is
already a star takes one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import store


MOST, LEAST = 50_000, 500
CHUNK = 500_000  # edges that a task holds at once


def forest(a, b):
    """(node, smallest node of what hangs together) by the edges (a, b), for
    all but the smallest ones."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))  # numbered like the nodes: smaller is smaller
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(low, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (low[low] != low).any():
            low = low[low]
    hangs = low != np.arange(len(low))
    return nodes[hangs], nodes[low[hangs]]


def _forests(batches):
    """The forest of a task's edges (a, b), in chunks. The last node goes on
    into the next chunk: edges that arrive by node stay together."""
    import numpy as np
    import pyarrow as pa

    def rows(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          ["a", "b"])

    held: list = []
    size = 0
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")])
        size += batch.num_rows
        if size >= CHUNK:
            last = held[-1][0][-1] if batch.num_rows else None
            a, b = forest(*map(np.concatenate, zip(*held)))
            stays = a == last
            yield rows(a[~stays], b[~stays])
            held, size = [[a[stays], b[stays]]], int(stays.sum())
    if size:
        yield rows(*forest(*map(np.concatenate, zip(*held))))


def _stars(edges: DataFrame) -> DataFrame:
    """Step 2, stored."""
    kind = "a long, b long"
    return store(edges.mapInArrow(_forests, kind).repartition("a").sortWithinPartitions("a")
                 .mapInArrow(_forests, kind), "edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long): the smallest node
    of its component. Nulls and loops in ``edges`` are ignored."""
    now = _stars(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                              F.least("a", "b").alias("b")))
    while True:
        limit = max(LEAST, now.count() // MOST)
        above = now.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        below = now.groupBy("b").agg(F.count("*").alias("n")).withColumnRenamed("b", "a")
        # a star has no node below two others, and none below one and above another
        nodes = store(above.join(below, "a", "full").withColumn(
            "open", F.coalesce((F.col("low") < F.col("high")) | F.col("n").isNotNull() & F.col("low").isNotNull(),
                               F.lit(False))).where((F.col("n") > limit) | F.col("open")), "nodes")
        if not nodes.where("open").head(1):
            break
        parents = nodes.where("n is not null").select(
            F.col("a").alias("b"), F.coalesce("low", "a").alias("to"), "n")
        hot = parents.where(F.col("n") > limit).select("b", F.col("to").alias("h"))  # <= MOST rows
        marked = now.join(F.broadcast(hot), "b", "left")
        cold = marked.where("h is null").select("a", "b").join(
            parents.where(F.col("n") <= limit).select("b", "to"), "b", "left")
        now = _stars(cold.select("a", F.coalesce("to", "b").alias("b")).unionByName(
            marked.where("h is not null").select("a", F.col("h").alias("b"))))
    return now.distinct().toDF("node", "root").unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
