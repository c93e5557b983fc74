"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame``; the oracle is an
independent SQL formulation of the same result over the same tables.
Column names and kinds agree on both sides (integer block coordinates and
counts as BIGINT, values and ratings as DOUBLE).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvid.operators import graph as G
from corvid.operators import matrix as M
from corvid.operators import ratings as R
from corvid.plans import bindings as B
from corvid.session import scratch_path
from corvid.sources import (REJECTS, observe_rejects, parse_cells, parse_edges, parse_links,
                            parse_ratings, read_cells, read_in_order, read_lines, read_links,
                            read_ratings, strip_headers, write_delimited, write_lines)

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- matrices


def mat_block_coords(spark, d):
    return M.block_coords(M.resolve_duplicates(B.all_cells(spark, d), "sum"))


def mat_block_assemble(spark, d):
    return M.block_assemble(B.all_cells(spark, d), on_duplicate="sum")


def mat_add_outer(spark, d):
    return M.matrix_add(B.matrix_m(spark, d), B.matrix_n(spark, d), how="outer",
                        on_duplicate="sum")


def mat_add_blockjoin(spark, d):
    return M.matrix_add(B.matrix_m(spark, d), B.matrix_n(spark, d), how="inner",
                        on_duplicate="sum")


def mat_add_max(spark, d):
    return M.matrix_add(B.matrix_m(spark, d), B.matrix_n(spark, d), how="outer",
                        on_duplicate="max")


def mat_add_text(spark, d):
    """Text in, as the matrix programs read it: ``i,j,v`` lines -> sum."""
    m = parse_cells(B.cell_lines(B.matrix_m(spark, d)))
    n = parse_cells(B.cell_lines(B.matrix_n(spark, d)))
    return M.matrix_add(m, n, how="outer", on_duplicate="sum")


def mat_add_checked(spark, d):
    """Default duplicate policy (``error``) over inputs without repeats."""
    m = M.resolve_duplicates(B.matrix_m(spark, d), "sum")
    n = M.resolve_duplicates(B.matrix_n(spark, d), "sum")
    return M.matrix_add(m, n)


def mat_add_blockjoin_checked(spark, d):
    """Block-inner addition with the default duplicate policy."""
    m = M.resolve_duplicates(B.matrix_m(spark, d), "sum")
    n = M.resolve_duplicates(B.matrix_n(spark, d), "sum")
    return M.matrix_add(m, n, how="inner")


def _through_files(spark, label, lines):
    """Lines written as text files in the shared folder; their path."""
    path = scratch_path(spark, label)
    lines.write.text(path)
    return path


def _written(spark, label, result, sink):
    """A result written by a text sink and read back with its own schema."""
    path = scratch_path(spark, label)
    sink(result, path, sep="\t")
    return spark.read.option("sep", "\t").csv(path, schema=result.schema)


def _in_order(spark, label, result, sink):
    """An ordered result written by a text sink and read back with the place
    ``pos`` of every line in the files."""
    path = scratch_path(spark, label)
    sink(result, path, sep="\t")
    return read_in_order(spark, path, result.schema)


def mat_add_files(spark, d):
    """Matrix files in, tab-separated cells out, read back."""
    m, n = (read_cells(spark, _through_files(spark, k, B.cell_lines(f(spark, d))))
            for k, f in (("m", B.matrix_m), ("n", B.matrix_n)))
    return _written(spark, "sum", M.matrix_add(m, n, on_duplicate="sum"), write_delimited)


def mat_render_dense(spark, d):
    cells = M.resolve_duplicates(B.order_line_cells(spark, d), "sum")
    return M.render_dense(M.block_coords(cells, rows=100, cols=8), rows=100, cols=8)


# order x line-number blocks of 100 x 8: every order has a first line, few an
# eighth, so about half of the positions are stored
LINES = {"rows": 100, "cols": 8}


def mat_dense_blocks(spark, d):
    """Numeric dense blocks, one row per position (zeros included)."""
    cells = M.resolve_duplicates(B.order_line_cells(spark, d), "sum")
    return (M.dense_blocks(M.block_coords(cells, **LINES), **LINES)
            .select("bi", "bj", F.posexplode_outer("values").alias("_at", "v"))
            .select("bi", "bj", F.col("_at").cast("long").alias("pos"), "v"))


def mat_add_dense(spark, d):
    """Element-wise sum of the dense blocks of two full matrices: quantities
    and line numbers of all orders."""
    q, n = B.order_line_cells(spark, d), B.order_line_cells(spark, d, "l_linenumber")
    arrays = [M.block_arrays(M.block_coords(x, **LINES), **LINES, on_duplicate="sum") for x in (q, n)]
    return M.cells_from_arrays(M.add_block_arrays(*arrays), LINES["cols"])


def mat_add_dense_inner(spark, d):
    """Block-inner addition of dense blocks: returned lines and the others."""
    arrays = [M.block_arrays(M.block_coords(B.order_line_cells(spark, d, returned=r), **LINES),
                             **LINES, on_duplicate="sum") for r in (True, False)]
    return M.cells_from_arrays(M.add_block_arrays(*arrays, how="inner"), LINES["cols"])


def mat_add_blocks(spark, d):
    """Addition in the form that the blocks' fill calls for."""
    q, n = B.order_line_cells(spark, d), B.order_line_cells(spark, d, "l_linenumber")
    return M.matrix_add_blocks(q, n, on_duplicate="sum", **LINES)


# ---------------------------------------------------------------- graph


def _order_layout(spark, d):
    adj = B.order_adjacency(spark, d)
    return adj, G.layout_edges(G.adjacency_to_edges(adj))


def graph_candidates(spark, d):
    adj, layout = _order_layout(spark, d)
    return G.candidate_groups(layout, G.start_labels(
        G.vertex_universe(adj, "all", layout.edges()), layout))


def _minlabel(universe):
    def q(spark, d):
        return G.min_label_groups(B.order_adjacency(spark, d), universe)
    return q


def _sizes(universe):
    def q(spark, d):
        return G.group_sizes(_minlabel(universe)(spark, d))
    return q


def graph_text_group_sizes(spark, d):
    """Text in, as the graph programs read it: adjacency lines -> sizes."""
    adj = parse_links(B.order_adjacency_lines(spark, d))
    return G.group_sizes(G.min_label_groups(adj, "all"))


def graph_files_group_sizes(spark, d):
    """Adjacency files in (scanner style), tab-separated sizes out, read back."""
    path = _through_files(spark, "graph", B.scanned_adjacency_lines(spark, d))
    sizes = G.group_sizes(G.min_label_groups(read_links(spark, path, mode="prefix"), "all"))
    return _in_order(spark, "sizes", sizes, write_delimited)


def graph_pregel_min(spark, d):
    return G.pregel_min(G.adjacency_to_edges(B.order_adjacency(spark, d), distinct=False))


def graph_group_sizes_endpoints(spark, d):
    """Sizes of the groups the vertex program leaves over edge endpoints."""
    return G.group_sizes(graph_pregel_min(spark, d))


def graph_triplets(spark, d):
    """Triplets over the labels after one round."""
    adj, layout = _order_layout(spark, d)
    G.run_rounds(layout, G.vertex_universe(adj, "endpoints", layout.edges()), 1)
    return G.graph_triplets(layout.edges(), layout.tables.read("round-1", "id", G.LABELS), "src", layout,
                            G.hot_keys(layout.edges(), "dst"))


def adjacency_to_edges(spark, d):
    return parse_edges(B.lineitem_adjacency_lines(spark, d)).distinct()


# ---------------------------------------------------------------- ratings


def user_avg_rating(spark, d):
    return R.user_avg_rating(B.part_ratings(spark, d))


def rating_hist_avg(spark, d):
    return R.rating_histogram(B.part_ratings(spark, d), mode="avg")


def rating_hist_text(spark, d):
    """Text in, as the typed ratings program reads it (headers included)."""
    typed = parse_ratings(B.rating_lines(spark, d), mode="typed", user_type="bigint")
    return R.rating_histogram(typed, mode="avg")


def rating_hist_sql(spark, d):
    raw = parse_ratings(B.rating_lines(spark, d), mode="raw")
    return R.rating_histogram(raw, mode="sql")


def rating_hist_files(spark, d):
    """Ratings files in, histogram lines out, read back."""
    path = _through_files(spark, "ratings", B.rating_lines(spark, d))
    hist = R.rating_histogram(read_ratings(spark, path, mode="raw"), mode="sql")
    return _in_order(spark, "histogram", hist, write_lines)


def rating_rejects(spark, d):
    """Lines that the typed histogram of ratings files leaves out, by cause:
    counted by the pass that writes the histogram."""
    lines = B.rating_lines(spark, d).unionByName(B.broken_rating_lines(spark, d))
    path = _through_files(spark, "ratings", lines)
    observation = Observation("rating rejects")
    seen = observe_rejects(read_lines(spark, path), observation, user_type="bigint")
    typed = parse_ratings(seen, mode="typed", user_type="bigint")
    write_lines(R.rating_histogram(typed, mode="avg"), scratch_path(spark, "histogram"))
    counts = observation.get
    return spark.createDataFrame([(c, counts[c]) for c in ("lines", *REJECTS)],
                                 "cause string, n long")


def ratings_parse(spark, d):
    typed = parse_ratings(strip_headers(B.rating_lines(spark, d)), mode="typed",
                          user_type="bigint")
    return typed.select(F.col("user").alias("user_id"), "rating")


def ratings_parse_raw(spark, d):
    raw = parse_ratings(B.rating_lines(spark, d), mode="raw")
    return raw.select(F.col("user").alias("user_id"), "rating")


QUERIES: dict[str, Query] = {
    "mat_block_coords": mat_block_coords,
    "mat_block_assemble": mat_block_assemble,
    "mat_add_outer": mat_add_outer,
    "mat_add_blockjoin": mat_add_blockjoin,
    "mat_add_max": mat_add_max,
    "mat_add_text": mat_add_text,
    "mat_add_checked": mat_add_checked,
    "mat_add_files": mat_add_files,
    "mat_add_blockjoin_checked": mat_add_blockjoin_checked,
    "mat_render_dense": mat_render_dense,
    "mat_dense_blocks": mat_dense_blocks,
    "mat_add_dense": mat_add_dense,
    "mat_add_dense_inner": mat_add_dense_inner,
    "mat_add_blocks": mat_add_blocks,
    "graph_candidates": graph_candidates,
    "graph_minlabel_all": _minlabel("all"),
    "graph_minlabel_sources": _minlabel("sources"),
    "graph_minlabel_endpoints": _minlabel("endpoints"),
    "graph_group_sizes_all": _sizes("all"),
    "graph_group_sizes_sources": _sizes("sources"),
    "graph_group_sizes_endpoints": graph_group_sizes_endpoints,
    "graph_text_group_sizes": graph_text_group_sizes,
    "graph_files_group_sizes": graph_files_group_sizes,
    "graph_pregel_min": graph_pregel_min,
    "graph_triplets": graph_triplets,
    "adjacency_to_edges": adjacency_to_edges,
    "user_avg_rating": user_avg_rating,
    "rating_hist_avg": rating_hist_avg,
    "rating_hist_text": rating_hist_text,
    "rating_hist_sql": rating_hist_sql,
    "rating_hist_files": rating_hist_files,
    "rating_rejects": rating_rejects,
    "ratings_parse": ratings_parse,
    "ratings_parse_raw": ratings_parse_raw,
}

# ================================================================ oracles

_M = ("select l_orderkey i, cast(l_partkey as bigint) j, l_quantity v "
      "from lineitem where l_returnflag is not distinct from 'R'")
_N = ("select l_orderkey i, cast(l_partkey as bigint) j, l_quantity v "
      "from lineitem where l_returnflag is distinct from 'R'")
_A = "select l_orderkey i, cast(l_partkey as bigint) j, l_quantity v from lineitem"
_MN = f"with m as ({_M}), n as ({_N})"
_OUTER = ("select i // 100 bi, j // 100 bj, i % 100 oi, j % 100 oj, sum(v) v "
          "from (select * from m union all select * from n) group by all")

_INNER = (f"{_MN}, k as (select distinct i // 100 bi, j // 100 bj from m "
          f"intersect select distinct i // 100 bi, j // 100 bj from n), "
          f"a as ({_OUTER}) select a.bi, a.bj, a.oi, a.oj, a.v from a "
          f"join k on a.bi = k.bi and a.bj = k.bj")

_E = "select distinct o_custkey src, o_orderkey dst from orders"
_V = {
    "all": "select c_custkey id from customer union select o_custkey from orders "
           "union select o_orderkey from orders "
           "union select -(s_suppkey + 1) from supplier",
    "sources": "select c_custkey id from customer union select o_custkey from orders "
               "union select -(s_suppkey + 1) from supplier",
    "endpoints": "select src id from e union select dst from e",
}


def _label_ctes(universe: str, rounds: int = G.ROUNDS) -> str:
    """``with e, v, l0..l{rounds}``: each round is the min over the vertex's
    own group and the groups of its in-neighbours, kept to the universe."""
    parts = [f"e as ({_E})", f"v as ({_V[universe]})", "l0 as (select id, id grp from v)"]
    for k in range(rounds):
        parts.append(
            f"l{k + 1} as (select l.id, least(l.grp, coalesce(m.grp, l.grp)) grp "
            f"from l{k} l left join (select e.dst id, min(p.grp) grp from e "
            f"join l{k} p on e.src = p.id group by e.dst) m on l.id = m.id)")
    return "with " + ", ".join(parts)


_R = ("select l_partkey u, cast(cast(trunc(l_quantity) as integer) % 6 as double) r "
      "from lineitem")

ORACLES: dict[str, str] = {
    "mat_block_coords": f"select i // 100 bi, j // 100 bj, i % 100 oi, j % 100 oj, "
                        f"sum(v) v from ({_A}) group by all",
    "mat_block_assemble": f"with c as (select i, j, sum(v) v from ({_A}) group by i, j) "
                          f"select i // 100 bi, j // 100 bj, count(*) nnz, sum(v) total "
                          f"from c group by all",
    "mat_add_outer": f"{_MN} {_OUTER}",
    "mat_add_blockjoin": _INNER,
    "mat_add_blockjoin_checked": _INNER,
    "mat_add_max": f"{_MN}, mm as (select i, j, max(v) v from m group by i, j), "
                   f"nm as (select i, j, max(v) v from n group by i, j) "
                   f"select i // 100 bi, j // 100 bj, i % 100 oi, j % 100 oj, sum(v) v "
                   f"from (select * from mm union all select * from nm) group by all",
    "mat_add_text": f"{_MN} {_OUTER}",
    "mat_add_checked": f"{_MN} {_OUTER}",
    "mat_render_dense": "with c as (select l_orderkey i, cast(l_linenumber as bigint) j, "
                        "sum(l_quantity) v from lineitem group by 1, 2), "
                        "b as (select i // 100 bi, j // 8 bj, i % 100 oi, j % 8 oj, v from c), "
                        "g as (select k.bi, k.bj, r.oi, q.oj from (select distinct bi, bj from b) k, "
                        "range(100) r(oi), range(8) q(oj)) "
                        "select g.bi, g.bj, g.oi, string_agg(printf('%.3f', coalesce(b.v, 0.0)::double), "
                        "chr(9) order by g.oj) line from g left join b on b.bi = g.bi and "
                        "b.bj = g.bj and b.oi = g.oi and b.oj = g.oj group by 1, 2, 3",
    "graph_candidates": f"with e as ({_E}), v as ({_V['all']}) select id, min(grp) grp from "
                        f"(select id, id grp from v union all select dst, src from e) group by id",
    "graph_minlabel_all": _label_ctes("all") + " select id, grp from l5",
    "graph_minlabel_sources": _label_ctes("sources") + " select id, grp from l5",
    "graph_minlabel_endpoints": _label_ctes("endpoints") + " select id, grp from l5",
    "graph_group_sizes_all": _label_ctes("all") +
        " select grp, count(*) n from l5 group by grp order by grp",
    "graph_group_sizes_sources": _label_ctes("sources") +
        " select grp, count(*) n from l5 group by grp order by grp",
    "graph_group_sizes_endpoints": _label_ctes("endpoints") +
        " select grp, count(*) n from l5 group by grp order by grp",
    "graph_text_group_sizes": _label_ctes("all") +
        " select grp, count(*) n from l5 group by grp order by grp",
    "graph_pregel_min": _label_ctes("endpoints") + " select id, grp from l5",
    "graph_triplets": _label_ctes("endpoints", 1) +
        " select e.src, e.dst, e.src attr, s.grp src_grp, d.grp dst_grp from e "
        "join l1 s on e.src = s.id join l1 d on e.dst = d.id",
    "adjacency_to_edges": "select l_orderkey src, l_partkey dst from lineitem "
                          "union select l_orderkey, l_suppkey from lineitem",
    "user_avg_rating": f"with t as ({_R}) select u user_id, avg(r) avg_rating from t "
                       f"where r > 0 group by u",
    "rating_hist_avg": f"with t as ({_R}), b as (select cast(trunc(avg(r) * 10) as integer) b "
                       f"from t where r > 0 group by u) select cast(b as double) / 10 rating, "
                       f"count(*) n from b group by b order by 1",
    "rating_hist_text": f"with t as ({_R}), b as (select cast(trunc(avg(r) * 10) as integer) b "
                        f"from t where r > 0 group by u) select cast(b as double) / 10 rating, "
                        f"count(*) n from b group by b order by 1",
    "rating_hist_sql": f"with t as ({_R}), b as (select cast(trunc(sum(r) * 10 / count(r)) "
                       f"as integer) b from t group by u) select cast(b as double) / 10 rating, "
                       f"count(b) n from b group by b order by 1",
    "ratings_parse": f"with t as ({_R}) select u user_id, r rating from t",
    "ratings_parse_raw": "select cast(l_partkey as varchar) user_id, "
                         "cast(cast(trunc(l_quantity) as integer) % 6 as varchar) rating "
                         "from lineitem",
}

_OL = ("select l_orderkey // 100 bi, l_linenumber // 8 bj, l_orderkey % 100 oi, "
       "cast(l_linenumber % 8 as bigint) oj, sum({v}) v, "
       "max(case when l_returnflag is not distinct from 'R' then 1 else 0 end) r, "
       "max(case when l_returnflag is distinct from 'R' then 1 else 0 end) o "
       "from lineitem group by 1, 2, 3, 4")
ORACLES["mat_dense_blocks"] = (
    f"with b as ({_OL.format(v='l_quantity')}), "
    "g as (select k.bi, k.bj, p.pos from (select distinct bi, bj from b) k, range(800) p(pos)) "
    "select g.bi, cast(g.bj as bigint) bj, g.pos, coalesce(b.v, 0.0)::double v from g "
    "left join b on b.bi = g.bi and b.bj = g.bj and b.oi * 8 + b.oj = g.pos")
ORACLES["mat_add_dense"] = ORACLES["mat_add_blocks"] = (
    f"select bi, cast(bj as bigint) bj, oi, oj, v::double v "
    f"from ({_OL.format(v='l_quantity + l_linenumber')})")
ORACLES["mat_add_dense_inner"] = (
    f"with b as ({_OL.format(v='l_quantity')}), "
    "k as (select bi, bj from b group by bi, bj having max(r) = 1 and max(o) = 1) "
    "select b.bi, cast(b.bj as bigint) bj, b.oi, b.oj, b.v::double v from b "
    "join k on b.bi = k.bi and b.bj = k.bj")
ORACLES["mat_add_files"] = ORACLES["mat_add_outer"]
# the place of a row in the order of the result, as the files must hold it
ORACLES["graph_files_group_sizes"] = (
    f"select *, row_number() over (order by grp) - 1 pos from ({ORACLES['graph_group_sizes_all']})")
ORACLES["rating_hist_files"] = (
    f"select *, row_number() over (order by rating) - 1 pos from ({ORACLES['rating_hist_sql']})")
# every line of an order is a rating, the first also a header; lines 2, 3 and 4
# are broken once more: no rating, no number, no user
ORACLES["rating_rejects"] = """
with l as (select l_linenumber k, cast(trunc(l_quantity) as integer) % 6 r from lineitem)
select 'lines' cause, count(*) + count(*) filter (k <= 4) n from l
union all select 'header', count(*) filter (k = 1) from l
union all select 'no_rating', count(*) filter (k = 2) from l
union all select 'bad_rating', count(*) filter (k = 3) from l
union all select 'bad_user', count(*) filter (k = 4) from l
union all select 'not_positive', count(*) filter (r <= 0) from l
"""

FLAGSHIP = "rating_hist_avg"
