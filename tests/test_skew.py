"""One key holding a third of all rows: results stay exact on every path."""

import random

from corvid.operators import graph as G
from corvid.operators import matrix as M
from corvid.operators.ratings import rating_histogram
from corvid.sources import parse_adjacency, parse_ratings
from tests.conftest import lines_df
from tests.test_graph import brute


def test_hot_target_in_triplet_form(spark):
    # 30 of ~90 edges point at vertex 99; threshold 4 salts it on the target side
    rnd = random.Random(7)
    lines = [f"{k},99" for k in range(30)]
    lines += [f"{k},{rnd.randrange(60)},{rnd.randrange(60)}" for k in range(30)]
    a = parse_adjacency(lines_df(spark, lines))
    e = G.adjacency_to_edges(a)
    hot = G.hot_keys(e, "dst", threshold=4)
    assert 99 in {r.hk for r in hot.table.collect()}
    got = {r.id: r.grp for r in G.pregel_min(e, hot_threshold=4).collect()}
    assert got == brute(lines, "endpoints")
    got = {r.id: r.grp for r in G.min_label_groups(a, "all", hot_threshold=4).collect()}
    assert got == brute(lines, "all")


def test_hot_source_and_target_triplets_match_plain_join(spark):
    lines = ["0," + ",".join(str(k) for k in range(1, 31))] + [f"{k},0" for k in range(1, 31)]
    a = parse_adjacency(lines_df(spark, lines))
    e = G.adjacency_to_edges(a)
    lab = G.init_labels(G.vertex_universe(a, "endpoints", e))
    plain = sorted(tuple(r) for r in G.graph_triplets(e, lab).collect())
    layout = G.layout_edges(e, "src", threshold=5, partitions=4)
    hot_dst = G.hot_keys(e, "dst", threshold=5)
    lab4 = lab.repartition(4, "id")
    salted = sorted(tuple(r) for r in G.graph_triplets(e, lab4, "src", layout, hot_dst).collect())
    assert salted == plain and len(plain) == 60


def test_hot_user_in_ratings(spark):
    rows = [(1, (k % 5) + 1) for k in range(40)] + [(u, (u % 5) + 1) for u in range(2, 82)]
    lines = [f"{u},{r},d" for u, r in rows]
    got = [tuple(x) for x in rating_histogram(parse_ratings(lines_df(spark, lines)), "avg").collect()]
    by_user = {}
    for u, r in rows:
        by_user.setdefault(u, []).append(r)
    expect = {}
    for rs in by_user.values():
        b = int(sum(rs) / len(rs) * 10) / 10
        expect[b] = expect.get(b, 0) + 1
    assert got == sorted(expect.items())


def test_hot_cell_in_matrix(spark):
    m = spark.createDataFrame([(5, 5, 1.0)] * 50 + [(k, k, 2.0) for k in range(100)],
                              "i long, j long, v double")
    n = spark.createDataFrame([(5, 5, 0.5)], "i long, j long, v double")
    got = {(r.bi, r.bj, r.oi, r.oj): r.v for r in M.matrix_add(m, n, on_duplicate="sum").collect()}
    assert got[(0, 0, 5, 5)] == 50.0 + 2.0 + 0.5
    assert len(got) == 100
