"""Minimum-label propagation on a directed graph for a fixed number of
rounds, and the sizes of the resulting groups.

Data model: ``adjacency(id, adj)`` as read from text, normalised to
``edges(src, dst)`` plus a vertex universe ``vertices(id)``; labels are
``(id, grp)``. A label moves along edge direction only, so after ``k`` rounds
``grp`` is the smallest id that reaches the vertex in at most ``k`` hops (or
its own id) -- not connected components.

Execution plan (see ``propagate``):

* edges are prepared once (``layout_edges``), split by source degree, and kept
  as tables in the run's folder (``corvid.session.Tables``). Edges of ordinary
  sources are hash-partitioned and sorted on ``src``; edges of "hot" sources
  (more than a threshold of out-edges) are spread evenly over all partitions
  instead. The hot-key table has a proven size bound (``hot_keys``). Repeated
  edges stay: ``min`` ignores them, and making them distinct would cost a
  shuffle of its own.
* labels are hash-partitioned and sorted on ``id`` with the same partition
  count, so the join of ordinary edges with labels needs no exchange and no
  sort of the edges; hot edges are joined with a broadcast of the hot sources'
  labels only (at most ``MAX_HOT_KEYS`` rows). Edges never move after the
  layout, labels never move in full.
* only labels that changed in the round before are sent, and the loop stops
  when none has changed: the others have been sent already.
* messages are reduced with ``min`` per target, partially in the map tasks
  (a target with a third of all edges leaves one row per task), exchanged
  once, and merged into the labels with a left join + ``least``; the
  reduced messages are partitioned like the labels, so that join adds no
  exchange either, and targets outside the universe drop out.
* every round's labels are a table ``round-0``, ``round-1``, ...: a lost
  executor costs a re-read, and after a lost driver ``resume`` goes on from
  the last finished round. Rounds are planned in a session of their own, so
  the caller's session keeps its settings throughout.

Building is executing: ``layout_edges``, ``propagate``, ``min_label_groups`` and
``pregel_min`` run their jobs (layout and rounds) before they return.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.session import (Tables, cut_lineage, default_parallelism, path_exists,
                            scratch_path)

ROUNDS = 5  # fixed value: propagation rounds of the reference programs
UNIVERSES = ("all", "sources", "endpoints")

# A key with more edges than this is "hot". The threshold is raised when
# needed so that at most MAX_HOT_KEYS keys are hot, which bounds every
# broadcast made from the hot-key table.
HOT_EDGES = 1_000_000
MAX_HOT_KEYS = 100_000
# Edges per partition of the laid-out edges (and labels) when the partition
# count is chosen from the data: ~16 MB of edge rows per task.
EDGES_PER_PARTITION = 1_000_000


# ---------------------------------------------------------------- topology


def adjacency_to_edges(adj: DataFrame, distinct: bool = True) -> DataFrame:
    """``(id, adj)``, or links ``(id, dst)`` with a null ``dst`` for an id
    without neighbours, -> distinct ``(src, dst)``; lines repeating an id add
    their neighbours (union of adjacency). ``distinct=False`` keeps repeated
    edges (enough for propagation, and no shuffle)."""
    if "adj" not in adj.columns:
        links = adj.where(F.col("dst").isNotNull()).select(F.col("id").alias("src"), "dst")
        return links.distinct() if distinct else links
    # explode_outer + a filter on the generated column: a plain explode makes
    # the optimizer infer a size(adj) > 0 filter and push it below the
    # parser, where it re-evaluates the whole parse expression
    edges = (adj.select(F.col("id").alias("src"), F.explode_outer("adj").alias("dst"))
             .where(F.col("dst").isNotNull()))
    return edges.distinct() if distinct else edges


def vertex_universe(adj: DataFrame, kind: str = "all",
                    edges: DataFrame | None = None) -> DataFrame:
    """Distinct vertex ids counted by the propagation.

    ``all``: every id with an input line and every neighbour.
    ``sources``: ids with an input line only (neighbour-only ids dropped).
    ``endpoints``: ids on some edge (an id with a line but no edge, and not
    anybody's neighbour, is absent).
    """
    if kind not in UNIVERSES:
        raise ValueError(f"universe must be one of {UNIVERSES}, not {kind!r}")
    if edges is None:
        edges = adjacency_to_edges(adj)
    dsts = edges.select(F.col("dst").alias("id"))
    if kind == "all":
        return adj.select("id").unionByName(dsts).distinct()
    if kind == "sources":
        return adj.select("id").distinct()
    return edges.select(F.col("src").alias("id")).unionByName(dsts).distinct()


def init_labels(vertices: DataFrame) -> DataFrame:
    """Every vertex starts in the group of its own id."""
    return vertices.select("id", F.col("id").alias("grp"))


# ---------------------------------------------------------------- hot keys


@dataclass
class HotKeys:
    """Keys holding more than ``threshold`` edges: ``table`` is
    ``(hk, nsalt)`` with at most ``MAX_HOT_KEYS`` rows, or ``None`` when no
    key is hot. ``nsalt = ceil(degree / threshold)``."""
    table: DataFrame | None
    threshold: int
    n_edges: int = 0

    def labels_of(self, labels: DataFrame) -> DataFrame:
        """The labels of hot keys only: at most ``MAX_HOT_KEYS`` rows, safe
        to broadcast."""
        return labels.join(F.broadcast(self.table), F.col("id") == F.col("hk"), "left_semi")

    def salted_labels(self, labels: DataFrame) -> DataFrame:
        """Labels with a ``salt`` column: one copy per salt of a hot key
        (bounded total), salt 0 for the rest."""
        if self.table is None:
            return labels.select("id", "grp", F.lit(0).alias("salt"))
        nsalt = F.coalesce(F.col("nsalt"), F.lit(1))
        return (labels.join(F.broadcast(self.table), F.col("id") == F.col("hk"), "left")
                .select("id", "grp", F.explode(F.sequence(F.lit(0), nsalt - 1)).alias("salt")))

    def salt_rows(self, rows: DataFrame, key: str, spread: str) -> DataFrame:
        """Add a ``salt`` column to rows keyed by ``key``: rows of a hot key
        are spread over its salts by hashing ``spread``, the rest get 0."""
        if self.table is None:
            return rows.withColumn("salt", F.lit(0))
        nsalt = F.coalesce(F.col("nsalt"), F.lit(1))
        return (rows.join(F.broadcast(self.table), F.col(key) == F.col("hk"), "left")
                .select(*rows.columns, F.pmod(F.xxhash64(spread), nsalt).cast("int").alias("salt")))


def hot_keys(edges: DataFrame, key: str, threshold: int = HOT_EDGES,
             max_hot: int = MAX_HOT_KEYS) -> HotKeys:
    """Keys of ``edges`` with more than ``threshold`` edges.

    The threshold is raised to ``ceil(|E| / max_hot)`` when that is larger,
    so at most ``max_hot`` keys are hot and their salts total at most
    ``2 * max_hot``: a proven bound for every broadcast built from them. One
    job counts |E| and the largest degree (degrees partially aggregated);
    only when some degree is above the threshold are degrees counted again
    for the hot table. Nothing is kept on executors in between.
    """
    deg = edges.groupBy(F.col(key).alias("hk")).agg(F.count(F.lit(1)).alias("d"))
    n_edges, max_deg = deg.agg(F.sum("d"), F.max("d")).first()
    n_edges, max_deg = n_edges or 0, max_deg or 0
    t = max(int(threshold), math.ceil(n_edges / max_hot), 1)
    table = None
    if max_deg > t:
        table = cut_lineage(deg.where(F.col("d") > t)
                            .select("hk", F.ceil(F.col("d") / t).cast("int").alias("nsalt")))
    return HotKeys(table, t, n_edges)


# ---------------------------------------------------------------- edge layout


def partitions_for(spark, n_edges: int) -> int:
    """Partition count for ``n_edges`` edges: about ``EDGES_PER_PARTITION``
    per partition, at least the default parallelism."""
    return max(math.ceil(n_edges / EDGES_PER_PARTITION), default_parallelism(spark))


@dataclass
class EdgeLayout:
    """Edges laid out for repeated joins with labels on ``key``, as tables.

    ``light``: edges of ordinary keys, hash-partitioned and sorted on ``key``
    in ``tables.parts`` parts. ``heavy``: edges of hot keys, spread over all
    partitions by their other end, or ``None``.
    """
    light: DataFrame
    heavy: DataFrame | None
    hot: HotKeys
    key: str
    tables: Tables

    @property
    def partitions(self) -> int:
        return self.tables.parts

    def names(self) -> list[str]:
        return ["edges-light"] + (["edges-heavy", "hot"] if self.heavy is not None else [])

    def edges(self) -> DataFrame:
        """All edges, in the caller's session."""
        light = self.tables.files("edges-light", EDGES)
        return light if self.heavy is None else \
            light.unionByName(self.tables.files("edges-heavy", EDGES))

    def with_labels(self, labels: DataFrame, out: str = "grp") -> DataFrame:
        """``(src, dst, <out>)``: every edge with the label of its ``key``
        end. ``labels`` must be hash-partitioned on ``id`` into
        ``partitions`` parts for the ordinary edges to join in place."""
        k = self.key
        lab = labels.select(F.col("id").alias("_k"), F.col("grp").alias(out))
        # sort-merge on co-partitioned inputs: no exchange on either side,
        # whatever the size estimates say
        light = (self.light.hint("merge").join(lab, self.light[k] == lab["_k"])
                 .select("src", "dst", out))
        if self.heavy is None:
            return light
        hot_lab = F.broadcast(self.hot.labels_of(labels)
                              .select(F.col("id").alias("_k"), F.col("grp").alias(out)))
        heavy = (self.heavy.join(hot_lab, self.heavy[k] == hot_lab["_k"])
                 .select("src", "dst", out))
        return light.unionByName(heavy)


def layout_edges(edges: DataFrame, key: str = "src", threshold: int = HOT_EDGES,
                 max_hot: int = MAX_HOT_KEYS, partitions: int | None = None,
                 folder: str | None = None) -> EdgeLayout:
    """Lay ``edges`` out for joins on ``key`` (written once, to ``folder`` or a
    fresh one); repeated edges stay."""
    other = "dst" if key == "src" else "src"
    spark = edges.sparkSession
    base = edges.select(F.col("src").cast("long"), F.col("dst").cast("long"))
    hot = hot_keys(base, key, threshold, max_hot)
    n = partitions or partitions_for(spark, hot.n_edges)
    tables = Tables(spark, folder or scratch_path(spark, "graph"), n)
    light = base
    if hot.table is not None:
        tagged = base.join(F.broadcast(hot.table), F.col(key) == F.col("hk"), "left")
        light = tagged.where(F.col("hk").isNull()).select("src", "dst")
        tables.write("edges-heavy", tagged.where(F.col("hk").isNotNull())
                     .select("src", "dst").repartition(n, other), other)
        hot.table.write.mode("overwrite").parquet(tables.path("hot"))
    tables.write("edges-light", light.repartition(n, key), key)
    spark.createDataFrame([(n, key, hot.threshold, hot.n_edges, hot.table is not None)], ABOUT) \
        .coalesce(1).write.mode("overwrite").parquet(tables.path("layout"))
    return _layout(tables, key, hot.threshold, hot.n_edges, hot.table is not None)


# columns of the tables of a run
EDGES, HOT, LABELS = "src long, dst long", "hk long, nsalt int", "id long, grp long, changed boolean"
ABOUT = "parts int, key string, threshold long, n_edges long, heavy boolean"


def _layout(tables: Tables, key: str, threshold: int, n_edges: int, heavy: bool) -> EdgeLayout:
    return EdgeLayout(
        tables.read("edges-light", key, EDGES),
        tables.read("edges-heavy", "dst" if key == "src" else "src", EDGES) if heavy else None,
        HotKeys(tables.spark.read.schema(HOT).parquet(tables.path("hot")) if heavy else None,
                threshold, n_edges), key, tables)


def open_layout(spark, folder: str) -> EdgeLayout:
    """The layout that ``layout_edges`` wrote to ``folder``."""
    r = spark.read.schema(ABOUT).parquet(f"{folder.rstrip('/')}/layout").first()
    return _layout(Tables(spark, folder, r["parts"]), r["key"], r["threshold"], r["n_edges"], r["heavy"])


# ---------------------------------------------------------------- rounds


def candidate_groups(layout: EdgeLayout, labels: DataFrame) -> DataFrame:
    """One round in union form: every vertex's own group and the group of
    each in-neighbour, reduced with ``min``. Targets of edges that have no
    label yet become labelled (neighbour-only vertices enter here).
    ``labels`` are partitioned like the layout (``start_labels``)."""
    msgs = layout.with_labels(labels).select(F.col("dst").alias("id"), "grp")
    return (labels.select("id", "grp").unionByName(msgs)
            .groupBy("id").agg(F.min("grp").alias("grp")))


def _apply_messages(labels: DataFrame, messages: DataFrame) -> DataFrame:
    """Merge ``(id, grp)`` messages into labels: ``min`` per target (partial
    in the map tasks), then left join + ``least``; ids not in ``labels`` are
    not added. ``changed`` marks the labels that fell."""
    best = messages.groupBy("id").agg(F.min("grp").alias("m"))
    # labels and reduced messages are both hash-partitioned on id: a
    # sort-merge join reads them in place (never a broadcast chosen from
    # size estimates)
    lower = F.coalesce(F.col("m") < F.col("grp"), F.lit(False))
    return (labels.hint("merge").join(best, "id", "left")
            .select("id", F.when(lower, F.col("m")).otherwise(F.col("grp")).alias("grp"),
                    lower.alias("changed")))


def start_labels(vertices: DataFrame, layout: EdgeLayout) -> DataFrame:
    """Initial labels (table ``round-0``), partitioned and sorted like the
    layout's edges; all count as changed."""
    labels = (vertices.groupBy("id").agg(F.min("id").alias("grp"))
              .withColumn("changed", F.lit(True)).repartition(layout.partitions, "id"))
    layout.tables.write("round-0", labels, "id")
    return layout.tables.read("round-0", "id", LABELS)


def run_rounds(layout: EdgeLayout, vertices: DataFrame | None, rounds: int, step=None,
               keep: bool = True) -> DataFrame:
    """Labels after ``rounds`` rounds of ``step`` (``propagation_round``), or
    after fewer if no label changes any more. Goes on after the last finished
    round in the layout's folder; ``vertices`` are only read if there is none.
    Every round stays readable (``round_labels``), or with ``keep`` false
    only the last one."""
    step = step or propagation_round
    tables = layout.tables
    done = max((k for k in range(rounds + 1) if tables.finished(f"round-{k}")), default=-1)
    if done < 0:
        if vertices is None:
            raise ValueError(f"no finished round in {tables.folder}")
        start_labels(vertices, layout)
        done = 0
    while done < rounds:
        labels = tables.read(f"round-{done}", "id", LABELS)
        if done and not labels.where("changed").head(1):
            break
        tables.write(f"round-{done + 1}", step(layout, labels), "id")
        if not keep:
            tables.drop(f"round-{done}")
        done += 1
    return round_labels(layout, done)


def round_labels(layout: EdgeLayout, number: int) -> DataFrame:
    """``(id, grp)`` after a finished round, in the caller's session."""
    return layout.tables.files(f"round-{number}", LABELS).select("id", "grp")


def started(spark, folder: str) -> bool:
    """Whether ``folder`` holds a run that ``resume`` can finish."""
    return path_exists(spark, f"{folder.rstrip('/')}/round-0/_SUCCESS")


def resume(spark, folder: str, rounds: int = ROUNDS, step=None) -> DataFrame:
    """Finish a run whose driver was lost, from the tables in ``folder``: the
    layout and the last finished round. The inputs are not read again."""
    return run_rounds(open_layout(spark, folder), None, rounds, step)


def _own_run(layout: EdgeLayout, vertices: DataFrame, rounds: int, step, folder: str | None):
    """``run_rounds`` of a layout nobody else uses: unless the caller named the
    folder, only the last round's table stays in it."""
    labels = run_rounds(layout, vertices, rounds, step, keep=folder is not None)
    # results read the files; no name stays behind in the catalog
    layout.tables.forget(*layout.names(), *(f"round-{k}" for k in range(rounds + 1)))
    if folder is None:
        layout.tables.drop(*layout.names(), "layout")
    return labels


def propagate(edges: DataFrame, vertices: DataFrame, rounds: int = ROUNDS,
              hot_threshold: int = HOT_EDGES, max_hot: int = MAX_HOT_KEYS,
              partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Labels ``(id, grp)`` of every vertex of ``vertices`` after ``rounds``
    rounds of min-label propagation along ``edges``. ``partitions`` sets how
    edges and labels are split (default: ``partitions_for`` the edge count).
    With ``folder`` the run's tables stay there for ``resume``."""
    layout = layout_edges(edges, "src", hot_threshold, max_hot, partitions, folder)
    return _own_run(layout, vertices, rounds, propagation_round, folder)


def propagation_round(layout: EdgeLayout, labels: DataFrame) -> DataFrame:
    """One round: every label that changed in the round before is sent along
    the out-edges of its vertex, the minimum kept per vertex."""
    msgs = (layout.with_labels(labels.where("changed"))
            .select(F.col("dst").alias("id"), "grp"))
    return _apply_messages(labels, msgs)


def group_sizes(labels: DataFrame) -> DataFrame:
    """``(grp, n)``: vertices per group, ordered by group."""
    return labels.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).orderBy("grp")


def min_label_groups(adj: DataFrame, universe: str = "all", rounds: int = ROUNDS,
                     hot_threshold: int = HOT_EDGES, partitions: int | None = None,
                     folder: str | None = None) -> DataFrame:
    """Adjacency (or links) -> labels after ``rounds`` rounds over the chosen
    universe. The vertices at edge ends are read from the laid-out edges."""
    layout = layout_edges(adjacency_to_edges(adj, distinct=False), "src", hot_threshold,
                          partitions=partitions, folder=folder)
    return _own_run(layout, vertex_universe(adj, universe, layout.edges()), rounds,
                    propagation_round, folder)


# ---------------------------------------------------------------- triplets


def graph_triplets(edges: DataFrame, labels: DataFrame, attr: str | None = "src",
                   src_layout: EdgeLayout | None = None,
                   hot_dst: HotKeys | None = None) -> DataFrame:
    """Triplet view ``(src, dst, attr, src_grp, dst_grp)``: every edge with
    the labels of both ends (inner joins: both ends must be labelled).
    ``attr`` is the edge attribute column, by default the source id.

    With ``src_layout`` the source labels are joined in place (see
    ``EdgeLayout.with_labels``) and ``edges`` is not read; the target labels
    need one exchange of the edges by target, where ``hot_dst`` spreads hot
    targets over salts.
    """
    if src_layout is None:
        s = labels.select(F.col("id").alias("_s"), F.col("grp").alias("src_grp"))
        step = edges.join(s, edges["src"] == s["_s"]).select("src", "dst", "src_grp")
    else:
        step = src_layout.with_labels(labels, "src_grp")
    attr_col = (F.col(attr) if attr else F.lit(None).cast("long")).alias("attr")
    step = step.select("src", "dst", attr_col, "src_grp")
    if hot_dst is None or hot_dst.table is None:
        # no hot target: join on the target alone, so labels partitioned on
        # id are read in place and only the edge rows move
        d = labels.select(F.col("id").alias("_d"), F.col("grp").alias("dst_grp"))
        return (step.hint("merge").join(d, step["dst"] == d["_d"])
                .select("src", "dst", "attr", "src_grp", "dst_grp"))
    step = hot_dst.salt_rows(step, "dst", "src")
    d = hot_dst.salted_labels(labels).select(
        F.col("id").alias("_d"), F.col("grp").alias("dst_grp"), F.col("salt").alias("_ds"))
    return (step.hint("merge").join(d, (step["dst"] == d["_d"]) & (step["salt"] == d["_ds"]))
            .select("src", "dst", "attr", "src_grp", "dst_grp"))


def pregel_min(edges: DataFrame, rounds: int = ROUNDS, hot_threshold: int = HOT_EDGES,
               max_hot: int = MAX_HOT_KEYS, partitions: int | None = None,
               folder: str | None = None) -> DataFrame:
    """Vertex-program form, vertices = edge endpoints.

    Each vertex starts with its own id. Per superstep the edges of vertices
    whose group changed send the edge attribute (the source id), or the
    source's group once that is smaller; a vertex keeps the minimum of its
    group and its messages, and the program halts when no group changes.
    Messages are reduced before they move, so the target's group is compared
    where it is and no superstep moves the edges. Gives the same labels as
    ``propagate`` over the ``endpoints`` universe.
    """
    layout = layout_edges(edges, "src", hot_threshold, max_hot, partitions, folder)
    e = layout.edges()
    verts = e.select(F.col("src").alias("id")).unionByName(e.select(F.col("dst").alias("id")))
    return _own_run(layout, verts, rounds, pregel_round, folder)


def pregel_round(layout: EdgeLayout, labels: DataFrame) -> DataFrame:
    """One superstep of ``pregel_min``."""
    sent = layout.with_labels(labels.where("changed"), "src_grp")
    msg = F.when(F.col("src_grp") < F.col("src"), F.col("src_grp")).otherwise(F.col("src"))
    return _apply_messages(labels, sent.select(F.col("dst").alias("id"), msg.alias("grp")))
