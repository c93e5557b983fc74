"""Text sources and sinks over real files."""

import os
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.errors import PySparkException

from corvid.operators import graph as G
from corvid.operators import matrix as M
from corvid.operators.ratings import rating_histogram
from corvid.sources import (REJECTS, observe_rejects, parse_adjacency, parse_cells, parse_edges, parse_links,
                            parse_ratings, read_adjacency,
                            read_cells, read_in_order, read_lines, read_links, read_ratings,
                            strip_headers, write_delimited, write_lines)
from tests.test_graph import SMALL as GRAPH_SMALL
from tests.test_matrix import M_SMALL, N_SMALL
from tests.test_ratings import GOLDEN as RATINGS_GOLDEN
from tests.test_ratings import SMALL as RATINGS_SMALL


def write_text(lines, name="part-0.txt"):
    d = tempfile.mkdtemp(prefix="corvid-src-")
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_read_files_end_to_end(spark):
    m = read_cells(spark, write_text(M_SMALL))
    n = read_cells(spark, write_text(N_SMALL))
    assert M.matrix_add(m, n).count() == 12
    adj = read_adjacency(spark, write_text(GRAPH_SMALL))
    got = [tuple(r) for r in G.group_sizes(G.min_label_groups(adj)).collect()]
    assert got == [(0, 3), (1, 7)]
    for mode in ("avg", "sql"):
        r = read_ratings(spark, write_text(RATINGS_SMALL), "typed" if mode == "avg" else "raw")
        assert [tuple(x) for x in rating_histogram(r, mode).collect()] == RATINGS_GOLDEN


def test_header_filter_is_in_the_scan(spark):
    df = strip_headers(read_lines(spark, write_text(RATINGS_SMALL)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EndsWith" in plan
    assert df.count() == 15


def test_sinks_round_trip(spark):
    out = tempfile.mkdtemp(prefix="corvid-out-")
    sizes = G.group_sizes(G.min_label_groups(read_adjacency(spark, write_text(GRAPH_SMALL))))
    write_delimited(sizes, os.path.join(out, "sizes"))
    back = spark.read.option("sep", "\t").csv(os.path.join(out, "sizes"), schema="grp long, n long")
    assert sorted(tuple(r) for r in back.collect()) == [(0, 3), (1, 7)]
    cells = read_cells(spark, write_text(M_SMALL))
    write_lines(cells, os.path.join(out, "cells"))
    again = read_cells(spark, os.path.join(out, "cells"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, cells.collect()))


def test_edges_parser_matches_adjacency_parser(spark):
    lines = GRAPH_SMALL + ["77", "5,,", "-3,+4"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    edges = G.adjacency_to_edges(parse_adjacency(df), distinct=False)
    assert sorted(map(tuple, parse_edges(df).collect())) == sorted(map(tuple, edges.collect()))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_checks_cannot_be_pruned(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        def lines(*x):
            return spark.createDataFrame([(y,) for y in x], "value string")
        frames = [parse_cells(lines("1,2,3", bad)) for bad in
                  ("a,1,2", "1,b,2", "1,2,c", "1,2", "-1,0,4", "0,-1,4", "1 1,2,3",
                   "9223372036854775808,1,2")]
        frames += [f(lines("1,2", bad)) for f in (parse_adjacency, parse_edges)
                   for bad in ("x,2", "1,2,y", "1,,2", "1, 2", "1,9223372036854775808", "x", "")]
        for df in frames:
            with pytest.raises(PySparkException):
                df.count()
            for c in df.columns:
                with pytest.raises(PySparkException):
                    df.select(c).collect()
        got = parse_adjacency(lines("4,2,99999999999999999999,3", "5,1,x", "6,+7,-8", "7, 2"),
                              mode="prefix").collect()
        assert sorted((r.id, r.adj) for r in got) == [(4, [2]), (5, [1]), (6, [7, -8]), (7, [])]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_split_once(spark):
    """However many checks and projections read the tokens, over files and
    over lines derived from a table."""
    path = write_text(["1,2,3.5", "4,5,6.5"])
    derived = spark.range(5).selectExpr("concat_ws(',', id, id, format_string('%.3f', id / 2)) value")
    for cells in (read_cells(spark, path), parse_cells(derived)):
        for df in (cells, cells.groupBy("i", "j").sum("v"),
                   M.matrix_add(cells, cells, on_duplicate="sum")):
            plan = plan_of(df)
            assert plan.count("split(") == plan.count("FileScan ") + plan.count("Range ("), plan
            assert plan.count("format_string(") <= 2
    lines = spark.range(5).selectExpr("concat_ws(',', id, id + 1, id + 2) value")
    for mode in ("strict", "prefix"):
        for df in (parse_adjacency(lines, mode), parse_links(lines, mode),
                   G.adjacency_to_edges(parse_links(lines, mode)),
                   G.adjacency_to_edges(parse_adjacency(lines, mode))):
            assert plan_of(df).count("split(") == 1, plan_of(df)
    assert plan_of(parse_edges(lines)).count("split(") == 1
    assert "transform(" not in plan_of(parse_links(lines))


def test_links_match_adjacency(spark):
    lines = GRAPH_SMALL + ["77", "5,,", "-3,+4"]
    scanned = lines + ["8,1,x,9", "9,99999999999999999999,1", "10, 2"]
    for mode, some in (("strict", lines), ("prefix", lines), ("prefix", scanned)):
        df = spark.createDataFrame([(x,) for x in some], "value string")
        want = sorted(((r.id, d) for r in parse_adjacency(df, mode).collect()
                       for d in (r.adj or [None])), key=str)
        assert sorted(map(tuple, parse_links(df, mode).collect()), key=str) == want
        a = G.group_sizes(G.min_label_groups(parse_adjacency(df, mode))).collect()
        assert G.group_sizes(G.min_label_groups(parse_links(df, mode))).collect() == a


@pytest.mark.parametrize("read, bad", [
    (read_cells, "7,x,2.0"), (read_cells, "1,2"), (read_cells, "-4,1,1"),
    (read_adjacency, "1,2,oops"), (read_links, "3,,4")])
def test_messages_name_the_file_and_the_line(spark, read, bad):
    path = write_text(["1,2,3", "4,5,6"], "good.txt")
    with open(os.path.join(path, "broken.txt"), "w") as f:
        f.write("7,8,9\n" + bad + "\n")
    df = read(spark, path)
    with pytest.raises(PySparkException) as e:
        df.count()
    assert "broken.txt" in str(e.value) and f"'{bad}'" in str(e.value)
    assert "ReadSchema: struct<value:string>" in plan_of(df)  # the scan reads no more


# ------------------------------------------------------------ rejects, order


def brute_rejects(lines):
    found = dict.fromkeys(REJECTS, 0)
    for line in lines:
        t = line.split(",")
        if line.endswith(":"):
            found["header"] += 1
            continue
        if len(t) < 2:
            found["no_rating"] += 1
            continue
        try:
            rating = float(t[1])
        except ValueError:
            found["bad_rating"] += 1
            continue
        if rating <= 0:
            found["not_positive"] += 1
        elif not t[0].strip().isdigit():
            found["bad_user"] += 1
    return {"lines": len(lines), **found}


def test_rejects_are_counted_by_the_pass_itself(spark):
    lines = RATINGS_SMALL + ["7", "8,x,d", "8,0,d", "8,-1,d", "u,3,d", ",2,d", "9,4", "", "abc:", "1,2:"]
    path = write_text(lines)
    seen = Observation("rejects")
    df = rating_histogram(parse_ratings(observe_rejects(read_lines(spark, path), seen)))
    plan = plan_of(df)
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1, plan
    plain = rating_histogram(parse_ratings(read_lines(spark, path)))
    assert df.collect() == plain.collect()
    assert seen.get == brute_rejects(lines)


def test_sinks_keep_the_order_and_readers_restore_it(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="corvid-order-"), "o")
    rows = (spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 k", "id v")
            .repartition(5).orderBy("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_delimited(rows, out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([f for f in os.listdir(out) if f.startswith("part")]) > 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # many splits a file
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = read_in_order(spark, out, rows.schema).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.k for r in sorted(back, key=lambda r: r.pos)] == list(range(5000))
    assert sorted(r.pos for r in back) == list(range(5000))
