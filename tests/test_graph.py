"""Min-label propagation: shipped fixture, discriminating cases, salting,
triplet form against union form, brute force on random graphs."""

import random

import pytest
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from corvid.operators import graph as G
from corvid.sources import parse_adjacency
from tests.conftest import lines_df

SMALL = ["3,2,1", "2,4,3", "1,3,4,6", "5,6", "6,5,7,1", "0,8,9", "4,2,1", "8,0", "9,0", "7,6"]
SMALL_GOLDEN = [(0, 3), (1, 7)]
FAIL = (PySparkException, Py4JJavaError, Exception)


def adj(spark, lines, mode="strict"):
    return parse_adjacency(lines_df(spark, lines), mode=mode)


def labels(spark, lines, universe="all", **kw):
    return {r.id: r.grp for r in G.min_label_groups(adj(spark, lines), universe, **kw).collect()}


def sizes(df):
    return [tuple(r) for r in G.group_sizes(df).collect()]


def brute(lines, universe="all", rounds=G.ROUNDS):
    edges, srcs = set(), set()
    for line in lines:
        toks = line.split(",")
        v = int(toks[0])
        srcs.add(v)
        edges |= {(v, int(t)) for t in toks[1:] if t}
    if universe == "all":
        verts = srcs | {d for _, d in edges}
    elif universe == "sources":
        verts = set(srcs)
    else:
        verts = {s for s, _ in edges} | {d for _, d in edges}
    lab = {v: v for v in verts}
    for _ in range(rounds):
        new = dict(lab)
        for s, d in edges:
            if s in lab and d in new:
                new[d] = min(new[d], lab[s])
        lab = new
    return lab


@pytest.mark.parametrize("universe", G.UNIVERSES)
def test_small_golden(spark, universe):
    assert sizes(G.min_label_groups(adj(spark, SMALL), universe)) == SMALL_GOLDEN


def test_small_golden_pregel(spark):
    assert sizes(G.pregel_min(G.adjacency_to_edges(adj(spark, SMALL)))) == SMALL_GOLDEN


def test_dangling_vertex_by_universe(spark):
    assert labels(spark, ["5,9"], "all") == {5: 5, 9: 5}
    assert labels(spark, ["5,9"], "endpoints") == {5: 5, 9: 5}
    assert labels(spark, ["5,9"], "sources") == {5: 5}


def test_isolated_line_by_universe(spark):
    assert labels(spark, ["5"], "all") == {5: 5}
    assert labels(spark, ["5"], "sources") == {5: 5}
    assert labels(spark, ["5"], "endpoints") == {}


def test_five_rounds_on_a_chain(spark):
    chain = [f"{k},{k + 1}" for k in range(8)]
    got = labels(spark, chain, "all")
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1, 7: 2, 8: 3}
    got = labels(spark, chain, "sources")
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1, 7: 2}
    assert sizes(G.min_label_groups(adj(spark, chain), "all")) == [(0, 6), (1, 1), (2, 1), (3, 1)]
    assert sizes(G.min_label_groups(adj(spark, chain), "sources")) == [(0, 6), (1, 1), (2, 1)]


def test_direction_matters(spark):
    assert labels(spark, ["1,0", "2,1", "3,2"], "all") == {0: 0, 1: 1, 2: 2, 3: 3}


def test_repeated_id_lines_union_and_count_once(spark):
    assert labels(spark, ["1,2", "1,3"], "all") == {1: 1, 2: 1, 3: 1}
    assert sizes(G.min_label_groups(adj(spark, ["1,2", "1,3"]), "sources")) == [(1, 1)]


def test_bad_tokens(spark):
    with pytest.raises(FAIL, match="not an integer"):
        adj(spark, ["4,2,,3,"]).collect()
    got = adj(spark, ["4,2,,3,"], mode="prefix").collect()
    assert [(r.id, list(r.adj)) for r in got] == [(4, [2])]
    for mode in ("strict", "prefix"):
        got = adj(spark, ["4,2,"], mode=mode).collect()
        assert [(r.id, list(r.adj)) for r in got] == [(4, [2])]
    got = adj(spark, ["4,2,x,7"], mode="prefix").collect()
    assert [(r.id, list(r.adj)) for r in got] == [(4, [2])]
    with pytest.raises(FAIL, match="not an integer"):
        adj(spark, ["x,1"], mode="prefix").collect()


def test_rounds_parameter(spark):
    chain = [f"{k},{k + 1}" for k in range(4)]
    got = {r.id: r.grp for r in G.min_label_groups(adj(spark, chain), rounds=1).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3}


def test_candidates_one_round_union_form(spark):
    a = adj(spark, SMALL)
    e = G.adjacency_to_edges(a)
    for threshold in (G.HOT_EDGES, 1):
        layout = G.layout_edges(e, "src", threshold=threshold)
        lab = G.start_labels(G.vertex_universe(a, "all", e), layout)
        got = {r.id: r.grp for r in G.candidate_groups(layout, lab).collect()}
        assert got == brute(SMALL, "all", rounds=1)


def test_partition_count_follows_the_edges_alone(spark):
    before = G.partitions_for(spark, 10 ** 12)
    assert before == 10 ** 12 // G.EDGES_PER_PARTITION
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert G.partitions_for(spark, 10 ** 12) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_loop_stops_when_nothing_changes(spark):
    steps = []

    def step(layout, labels):
        steps.append(1)
        return G.propagation_round(layout, labels)

    e = G.adjacency_to_edges(adj(spark, ["0,1", "1,2", "5,5"]))
    layout = G.layout_edges(e)
    ends = G.vertex_universe(None, "endpoints", e)
    got = {r.id: r.grp for r in G.run_rounds(layout, ends, 50, step).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 5: 5} and len(steps) == 3


def test_universes_of_the_driver_graph_differ(spark):
    from corvid.plans.queries import QUERIES
    rows = [frozenset(map(tuple, QUERIES[f"graph_minlabel_{u}"](
        spark, "/root/testdata/sf0.001").collect())) for u in G.UNIVERSES]
    assert len(set(rows)) == 3


def test_hot_source_salting_gives_same_labels(spark):
    # vertex 0 holds most of the edges; threshold 3 spreads it over salts
    lines = ["0," + ",".join(str(k) for k in range(1, 40)), "1,2", "2,3", "41,0", "40,41"]
    a = adj(spark, lines)
    e = G.adjacency_to_edges(a)
    layout = G.layout_edges(e, "src", threshold=3)
    hot = {r.hk: r.nsalt for r in layout.hot.table.collect()}
    assert hot == {0: 13}
    assert layout.heavy.count() == 39 and layout.light.count() == 4
    # the hot source's edges are spread, not kept in one partition
    sizes = layout.heavy.rdd.glom().map(len).collect()
    assert max(sizes) < 39
    plain = labels(spark, lines, "all")
    assert plain == brute(lines, "all")
    assert labels(spark, lines, "all", hot_threshold=3) == plain
    pre = {r.id: r.grp for r in G.pregel_min(e, hot_threshold=3).collect()}
    assert pre == brute(lines, "endpoints")


def test_hot_key_bound(spark):
    # more keys above the threshold than allowed: the threshold rises to
    # ceil(|E| / max_hot), here 22 > every degree, so no key stays hot
    lines = [f"{k}," + ",".join(str(100 + x) for x in range(k + 2)) for k in range(10)]
    e = G.adjacency_to_edges(adj(spark, lines))
    hot = G.hot_keys(e, "src", threshold=1, max_hot=3)
    assert hot.table is None
    assert hot.threshold == -(-e.count() // 3) == 22
    # one key with 60 of 78 edges stays hot: threshold 26, 3 salts
    lines = ["0," + ",".join(str(100 + x) for x in range(60))] + \
        [f"{k},{200 + k},{300 + k}" for k in range(1, 10)]
    e = G.adjacency_to_edges(adj(spark, lines))
    hot = G.hot_keys(e, "src", threshold=1, max_hot=3)
    assert hot.threshold == 26
    assert [tuple(r) for r in hot.table.collect()] == [(0, 3)]
    assert labels(spark, lines, "all", hot_threshold=1) == brute(lines, "all")


def test_triplets(spark):
    a = adj(spark, ["1,2", "2,3"])
    e = G.adjacency_to_edges(a)
    lab = G.init_labels(G.vertex_universe(a, "endpoints", e))
    got = sorted(tuple(r) for r in G.graph_triplets(e, lab).collect())
    assert got == [(1, 2, 1, 1, 2), (2, 3, 2, 2, 3)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = 40
    lines = []
    for v in range(n):
        if rnd.random() < 0.8:
            k = rnd.choice([0, 1, 1, 2, 3])
            lines.append(",".join(str(x) for x in [v] + [rnd.randrange(n + 10) for _ in range(k)]))
    a = adj(spark, lines)
    e = G.adjacency_to_edges(a)
    for universe in G.UNIVERSES:
        got = labels(spark, lines, universe)
        assert got == brute(lines, universe), universe
        assert sum(c for _, c in sizes(G.min_label_groups(a, universe))) == len(got)
    pre = {r.id: r.grp for r in G.pregel_min(e).collect()}
    assert pre == brute(lines, "endpoints")


# ------------------------------------------------------------ rounds as tables


LONG_CHAIN = [f"{k},{k + 1}" for k in range(9)] + ["20,21", "21,20", "30"]


@pytest.mark.parametrize("threshold", [G.HOT_EDGES, 1])
@pytest.mark.parametrize("form", ["union", "pregel"])
def test_run_ends_after_round_three_and_is_finished_from_its_tables(spark, tmp_path, form, threshold):
    lines = LONG_CHAIN + ["0," + ",".join(str(k) for k in range(40, 60))]
    a = adj(spark, lines)
    folder = str(tmp_path / "run")
    step = G.propagation_round if form == "union" else G.pregel_round
    universe = "all" if form == "union" else "endpoints"

    def run(rounds, **options):
        if form == "union":
            return G.min_label_groups(a, rounds=rounds, hot_threshold=threshold, **options)
        return G.pregel_min(G.adjacency_to_edges(a), rounds, threshold, **options)

    run(3, folder=folder)
    # the driver is gone: another session that knows the folder and no names
    other = spark.newSession()
    layout = G.open_layout(other, folder)
    layout.tables.forget(*layout.names(), *[f"round-{k}" for k in range(4)])
    assert (layout.heavy is None) == (threshold > 1)
    done = {r.id: r.grp for r in G.resume(other, folder, 5, step).collect()}
    assert done == brute(lines, universe) == {r.id: r.grp for r in run(5).collect()}
    # every round is readable
    for k in range(6):
        got = {r.id: r.grp for r in G.round_labels(layout, k).collect()}
        assert got == brute(lines, universe, rounds=k)
    # resuming a finished run computes nothing
    calls = []
    again = G.resume(other, folder, 5, lambda *x: calls.append(1))
    assert not calls and {r.id: r.grp for r in again.collect()} == done


def test_a_round_that_was_cut_off_is_not_taken_for_finished(spark, tmp_path):
    folder = str(tmp_path / "run")
    a = adj(spark, LONG_CHAIN)
    G.min_label_groups(a, rounds=3, folder=folder)
    (tmp_path / "run" / "round-3" / "_SUCCESS").unlink()
    got = {r.id: r.grp for r in G.resume(spark, folder, 5).collect()}
    assert got == brute(LONG_CHAIN, "all")


def test_nothing_to_resume(spark, tmp_path):
    layout = G.layout_edges(G.adjacency_to_edges(adj(spark, ["1,2"])), folder=str(tmp_path / "x"))
    with pytest.raises(ValueError, match="no finished round"):
        G.resume(spark, layout.tables.folder)


def test_rounds_leave_the_session_alone(spark):
    """While rounds run in another thread, a query of the same session is
    planned with its own settings."""
    import threading

    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen, stop = set(), threading.Event()

    def watch():
        while not stop.is_set():
            q = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
            plan = q._jdf.queryExecution().executedPlan().toString()
            seen.add(("AdaptiveSparkPlan" in plan, spark.conf.get("spark.sql.shuffle.partitions")))

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        assert labels(spark, LONG_CHAIN, "all") == brute(LONG_CHAIN, "all")
    finally:
        stop.set()
        thread.join()
    assert seen == {(True, before)}


def test_only_the_last_round_stays(spark):
    from corvid.session import workspace

    with workspace(spark) as folder:
        labels(spark, LONG_CHAIN, "all")
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        listed = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(fs)
        inner = listed[0].getPath()
        names = sorted(x.getPath().getName() for x in inner.getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration()).listStatus(inner))
    assert len(listed) == 1 and names == ["round-5"]
