"""Block matrix addition: shipped fixture, discriminating cases, rendering."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from corvid.operators import matrix as M
from corvid.sources import parse_cells
from tests.conftest import lines_df

# Shipped 4 x 3 fixtures (one block).
M_SMALL = ["1,1,12.850", "1,2,17.923", "1,0,55.774", "0,1,95.891", "0,2,62.272",
           "0,0,87.892", "3,1,28.638", "3,2,88.290", "3,0,25.805", "2,1,25.771",
           "2,2,40.581", "2,0,40.835"]
N_SMALL = ["2,1,55.559", "2,2,8.298", "2,0,95.006", "0,1,71.047", "0,2,4.006",
           "0,0,35.742", "1,1,81.552", "1,2,43.122", "1,0,46.662", "3,1,33.330",
           "3,2,46.305", "3,0,6.816"]
SUM_SMALL = [[123.634, 166.938, 66.278], [102.436, 94.402, 61.045],
             [135.841, 81.330, 48.879], [32.621, 61.968, 134.595]]

FAIL = (PySparkException, Py4JJavaError, Exception)


def cells(spark, triples):
    return spark.createDataFrame([(int(i), int(j), float(v)) for i, j, v in triples],
                                 "i long, j long, v double")


def as_dict(df):
    return {(r.bi, r.bj, r.oi, r.oj): r.v for r in df.collect()}


def test_small_fixture(spark):
    m = parse_cells(lines_df(spark, M_SMALL))
    n = parse_cells(lines_df(spark, N_SMALL))
    for how in ("outer", "inner"):
        got = as_dict(M.matrix_add(m, n, how=how))
        assert len(got) == 12
        for i in range(4):
            for j in range(3):
                assert got[(0, 0, i, j)] == pytest.approx(SUM_SMALL[i][j], abs=1e-9)


def test_outer_keeps_one_sided_blocks_inner_drops_them(spark):
    m = cells(spark, [(0, 0, 1)])
    n = cells(spark, [(0, 0, 2), (150, 0, 5)])
    assert as_dict(M.matrix_add(m, n, how="outer")) == {(0, 0, 0, 0): 3.0, (1, 0, 50, 0): 5.0}
    assert as_dict(M.matrix_add(m, n, how="inner")) == {(0, 0, 0, 0): 3.0}


def test_inner_is_by_block_not_by_cell(spark):
    m = cells(spark, [(0, 0, 1)])
    n = cells(spark, [(1, 1, 2)])
    for how in ("outer", "inner"):
        assert as_dict(M.matrix_add(m, n, how=how)) == {(0, 0, 0, 0): 1.0, (0, 0, 1, 1): 2.0}


def test_duplicate_policies(spark):
    m = cells(spark, [(0, 0, 1), (0, 0, 7)])
    n = cells(spark, [])
    with pytest.raises(FAIL, match="duplicate cell"):
        M.matrix_add(m, n).collect()
    assert as_dict(M.matrix_add(m, n, on_duplicate="sum")) == {(0, 0, 0, 0): 8.0}
    assert as_dict(M.matrix_add(m, n, on_duplicate="max")) == {(0, 0, 0, 0): 7.0}
    with pytest.raises(FAIL, match="duplicate cell"):
        M.resolve_duplicates(m).collect()
    assert [tuple(r) for r in M.resolve_duplicates(m, "max").collect()] == [(0, 0, 7.0)]


@pytest.mark.parametrize("how", ["outer", "inner"])
@pytest.mark.parametrize("bad", [[(500, 500, 1), (500, 500, 7)], [(-1, 0, 5)], [(0, -1, 5)]])
def test_checks_cannot_be_pruned(spark, how, bad):
    m = cells(spark, [(0, 0, 1)] + bad)  # block (5, 5) only in M: checked all the same
    n = cells(spark, [(0, 0, 2)])
    out = M.matrix_add(m, n, how=how)
    for df in (out, out.groupBy("bi", "bj"), *(out.select(c) for c in out.columns)):
        with pytest.raises(FAIL):
            df.count().collect() if hasattr(df, "agg") and not hasattr(df, "columns") else df.count()


def test_offsets_outside_the_block_fail(spark):
    blocks = spark.createDataFrame([(0, 0, -1, 0, 5.0)], "bi long, bj long, oi long, oj long, v double")
    for f in (M.render_dense, M.dense_blocks):
        with pytest.raises(FAIL):
            f(blocks, 2, 2).count()
        with pytest.raises(FAIL):
            f(M.block_coords(cells(spark, [(-1, 0, 5)]), 2, 2), 2, 2).collect()


def test_dense_blocks(spark):
    got = M.dense_blocks(M.block_coords(cells(spark, [(0, 1, 2), (1, 0, 3), (5, 5, 9)]), 2, 2), 2, 2)
    assert {(r.bi, r.bj): r["values"] for r in got.collect()} == {
        (0, 0): [0.0, 2.0, 3.0, 0.0], (2, 2): [0.0, 0.0, 0.0, 9.0]}


def test_duplicates_are_per_matrix_not_the_addition(spark):
    m = cells(spark, [(0, 0, 1)])
    n = cells(spark, [(0, 0, 2)])
    assert as_dict(M.matrix_add(m, n, on_duplicate="error")) == {(0, 0, 0, 0): 3.0}
    assert as_dict(M.matrix_add(m, n, on_duplicate="max")) == {(0, 0, 0, 0): 3.0}


def test_no_leak_across_blocks(spark):
    m = cells(spark, [(0, 0, 1), (0, 100, 2), (100, 0, 3)])
    n = cells(spark, [])
    out = M.matrix_add(m, n, how="outer")
    assert as_dict(out) == {(0, 0, 0, 0): 1.0, (0, 1, 0, 0): 2.0, (1, 0, 0, 0): 3.0}
    per_block = {(r.bi, r.bj): r.nnz for r in M.block_assemble(M.cells_from_blocks(out)).collect()}
    assert per_block == {(0, 0): 1, (0, 1): 1, (1, 0): 1}
    assert M.matrix_add(m, n, how="inner").count() == 0


def test_negative_index_rejected(spark):
    with pytest.raises(FAIL, match="negative cell index"):
        parse_cells(lines_df(spark, ["-1,0,1"])).collect()


def test_bad_cell_line_rejected(spark):
    with pytest.raises(FAIL):
        parse_cells(lines_df(spark, ["1,x,1.0"])).collect()
    with pytest.raises(FAIL):
        parse_cells(lines_df(spark, ["1,2"])).collect()


def test_bad_values_fail_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(FAIL, match="numeric value"):
            parse_cells(lines_df(spark, ["1,2,abc"])).collect()
        with pytest.raises(FAIL, match="not an integer"):
            parse_cells(lines_df(spark, ["99999999999999999999,2,1.0"])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_block_coords_large_indices(spark):
    big = 2 ** 40 + 123
    got = M.block_coords(cells(spark, [(big, 7, 1.0)])).collect()[0]
    assert (got.bi, got.oi, got.bj, got.oj) == (big // 100, big % 100, 0, 7)


def test_block_shape_parameters(spark):
    c = cells(spark, [(5, 7, 1.0)])
    got = M.block_coords(c, rows=4, cols=3).collect()[0]
    assert (got.bi, got.bj, got.oi, got.oj) == (1, 2, 1, 1)


def test_render_dense_zero_fills(spark):
    m = parse_cells(lines_df(spark, M_SMALL))
    n = parse_cells(lines_df(spark, N_SMALL))
    out = M.render_dense(M.matrix_add(m, n), rows=5, cols=4)
    lines = {r.oi: r.line for r in out.collect()}
    assert len(lines) == 5
    assert lines[0] == "123.634\t166.938\t66.278\t0.000"
    assert lines[3] == "32.621\t61.968\t134.595\t0.000"
    assert lines[4] == "0.000\t0.000\t0.000\t0.000"


def test_render_rounds_half_up(spark):
    out = M.render_dense(M.block_coords(cells(spark, [(0, 0, 1.0005)]), 1, 1), 1, 1)
    assert out.collect()[0].line == "1.001"


triple = st.tuples(st.integers(0, 250), st.integers(0, 250), st.integers(-5, 5))


@settings(max_examples=6, deadline=None)
@given(st.lists(triple, max_size=25, unique_by=lambda t: t[:2]),
       st.lists(triple, max_size=25, unique_by=lambda t: t[:2]))
def test_add_matches_brute_force_and_commutes(spark, ms, ns):
    m, n = cells(spark, ms), cells(spark, ns)
    expect = {}
    for i, j, v in ms + ns:
        key = (i // 100, j // 100, i % 100, j % 100)
        expect[key] = expect.get(key, 0.0) + v
    assert as_dict(M.matrix_add(m, n)) == expect
    assert as_dict(M.matrix_add(n, m)) == expect
    bm = {(i // 100, j // 100) for i, j, _ in ms}
    bn = {(i // 100, j // 100) for i, j, _ in ns}
    inner = {k: v for k, v in expect.items() if k[:2] in bm & bn}
    assert as_dict(M.matrix_add(m, n, how="inner")) == inner


# ------------------------------------------------------------ dense blocks


def arrays(df):
    return {(r.bi, r.bj): r.values for r in df.collect()}


def test_block_arrays_are_positional(spark):
    c = cells(spark, [(0, 0, 1), (1, 2, 5), (3, 1, 7), (2, 2, 9)])
    got = arrays(M.block_arrays(M.block_coords(c, 2, 3), 2, 3))
    assert got == {(0, 0): [1.0, None, None, None, None, 5.0],
                   (1, 0): [None, None, 9.0, None, 7.0, None]}
    assert arrays(M.dense_blocks(M.block_coords(c, 2, 3), 2, 3))[(0, 0)] == [1, 0, 0, 0, 0, 5]
    back = M.cells_from_arrays(M.block_arrays(M.block_coords(c, 2, 3), 2, 3), 3)
    assert as_dict(back) == as_dict(M.block_coords(c, 2, 3))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(1, 9)), max_size=25),
       st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(1, 9)), max_size=25),
       st.sampled_from(["outer", "inner"]), st.sampled_from(["sum", "max"]))
def test_array_form_equals_cell_form(spark, a, b, how, policy):
    m, n = cells(spark, a), cells(spark, b)
    added = M.add_block_arrays(*[M.block_arrays(M.block_coords(x, 3, 2), 3, 2, policy) for x in (m, n)],
                               how=how)
    assert as_dict(M.cells_from_arrays(added, 2)) == \
        as_dict(M.matrix_add(m, n, how=how, on_duplicate=policy, rows=3, cols=2))


def test_array_form_checks(spark):
    twice = M.block_coords(cells(spark, [(0, 0, 1), (0, 0, 2)]), 2, 2)
    assert arrays(M.block_arrays(twice, 2, 2, "sum")) == {(0, 0): [3.0, None, None, None]}
    outside = spark.createDataFrame([(0, 0, 5, 0, 1.0)], "bi long, bj long, oi long, oj long, v double")
    for df in (M.block_arrays(twice, 2, 2), M.block_arrays(outside, 2, 2)):
        with pytest.raises(FAIL):
            df.count()


def test_form_follows_the_fill(spark):
    full = cells(spark, [(i, j, 1) for i in range(4) for j in range(4)])
    sparse = cells(spark, [(0, 0, 1), (3, 3, 1)])
    assert M.fill(full, 2, 2) == 1.0 and M.fill(sparse, 2, 2) == 0.25
    assert M.fill(cells(spark, []), 2, 2) == 0.0
    plan = M.matrix_add_blocks(full, full, rows=2, cols=2)._jdf.queryExecution().toString()
    assert "zip_with" in plan.lower() or "zipwith" in plan.lower()
    plan = M.matrix_add_blocks(full, sparse, rows=2, cols=2)._jdf.queryExecution().toString()
    assert "zipwith" not in plan.lower().replace("_", "")
    for other in (full, sparse):
        assert as_dict(M.matrix_add_blocks(full, other, rows=2, cols=2)) == \
            as_dict(M.matrix_add(full, other, rows=2, cols=2))
