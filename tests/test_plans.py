"""Plan shapes that the scale design relies on."""

from corvid.operators import graph as G
from corvid.operators import matrix as M
from corvid.operators.ratings import rating_histogram
from corvid.plans import bindings as B

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def after_round(adj, edges, layout):
    """The stored labels after one round."""
    G.run_rounds(layout, G.vertex_universe(adj, "all", edges), 1)
    return layout.tables.read("round-1", "id", G.LABELS)


def exchanges(plan):
    return [line.strip() for line in plan.splitlines() if "Exchange" in line
            and "BroadcastExchange" not in line and "ReusedExchange" not in line]


def test_round_moves_only_reduced_messages(spark):
    adj = B.order_adjacency(spark, SF)
    edges = G.adjacency_to_edges(adj)
    layout = G.layout_edges(edges, "src", partitions=8)
    labels = after_round(adj, edges, layout)
    plan = plan_of(G.propagation_round(layout, labels))
    ex = exchanges(plan)
    assert len(ex) == 1, plan
    assert "partial_min" in plan
    assert not [x for x in plan.splitlines() if "Sort [src" in x], plan
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_round_keeps_its_own_partition_count(spark):
    # layout with 3 partitions in a session with 8 shuffle partitions: the
    # round must still read edges and labels in place
    adj = B.order_adjacency(spark, SF)
    edges = G.adjacency_to_edges(adj)
    layout = G.layout_edges(edges, "src", partitions=3)
    labels = after_round(adj, edges, layout)
    assert labels.rdd.getNumPartitions() == 3
    plan = plan_of(G.propagation_round(layout, labels))
    assert len(exchanges(plan)) == 1, plan
    got = {r.id: r.grp for r in G.propagate(edges, G.vertex_universe(adj, "all", edges),
                                            partitions=3).collect()}
    ref = {r.id: r.grp for r in G.propagate(edges, G.vertex_universe(adj, "all", edges)).collect()}
    assert got == ref


def test_round_with_hot_sources_broadcasts_only_hot_labels(spark):
    adj = B.order_adjacency(spark, SF)
    edges = G.adjacency_to_edges(adj)
    layout = G.layout_edges(edges, "src", threshold=5, partitions=8)
    assert layout.heavy is not None
    labels = after_round(adj, edges, layout)
    plan = plan_of(G.propagation_round(layout, labels))
    assert len(exchanges(plan)) == 1, plan
    # hot edges meet a broadcast of the hot labels only (a semi join with
    # the bounded hot-key table), ordinary edges a sort-merge join in place
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "SortMergeJoin" in plan


def test_outer_add_is_one_shuffle_with_partial_sum(spark):
    plan = plan_of(M.matrix_add(B.matrix_m(spark, SF), B.matrix_n(spark, SF), on_duplicate="sum"))
    assert len(exchanges(plan)) == 1, plan
    assert "partial_sum" in plan


def test_histogram_aggregates_partially_before_each_shuffle(spark):
    plan = plan_of(rating_histogram(B.part_ratings(spark, SF)))
    assert "partial_avg" in plan and "partial_count" in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = plan_of(B.matrix_m(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double," \
           "l_returnflag:string>" in plan
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan or \
        "PushedFilters: [EqualNullSafe(l_returnflag,R)]" in plan


def test_pregel_round_moves_only_reduced_messages(spark):
    edges = G.adjacency_to_edges(B.order_adjacency(spark, SF))
    layout = G.layout_edges(edges, "src", partitions=4)
    labels = G.start_labels(G.vertex_universe(None, "endpoints", layout.edges()), layout)
    plan = plan_of(G.pregel_round(layout, labels))
    ex = exchanges(plan)
    assert len(ex) == 1 and "hashpartitioning(id" in ex[0], plan
    assert "partial_min" in plan


def test_inner_add_has_no_join(spark):
    for policy in ("error", "sum"):
        plan = plan_of(M.matrix_add(B.matrix_m(spark, SF), B.matrix_n(spark, SF), how="inner",
                                    on_duplicate=policy))
        assert len(exchanges(plan)) == 2 and "Join" not in plan, plan
        assert plan.count("Scan parquet") == 2 and "partial_sum" in plan, plan


def test_array_addition_moves_each_input_once(spark):
    arrays = [M.block_arrays(M.block_coords(x(spark, SF)), on_duplicate="sum")
              for x in (B.matrix_m, B.matrix_n)]
    plan = plan_of(M.add_block_arrays(*arrays))
    assert len(exchanges(plan)) == 2 and plan.count("Scan parquet") == 2, plan
