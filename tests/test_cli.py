"""Command line: text files in, tab-separated text out."""

import os
import tempfile

import pytest

from corvid.__main__ import run
from tests.test_graph import SMALL as GRAPH_SMALL
from tests.test_matrix import M_SMALL, N_SMALL, SUM_SMALL
from tests.test_ratings import GOLDEN as RATINGS_GOLDEN
from tests.test_ratings import SMALL as RATINGS_SMALL
from tests.test_sources import write_text


def read_tsv(spark, path, schema):
    return sorted(tuple(r) for r in spark.read.option("sep", "\t").csv(path, schema=schema).collect())


def out_dir():
    return os.path.join(tempfile.mkdtemp(prefix="corvid-cli-"), "out")


def test_add(spark):
    out = out_dir()
    run(spark, ["add", write_text(M_SMALL), write_text(N_SMALL), out])
    got = read_tsv(spark, out, "bi long, bj long, oi long, oj long, v double")
    assert len(got) == 12
    for bi, bj, oi, oj, v in got:
        assert v == pytest.approx(SUM_SMALL[oi][oj], abs=1e-9)
    dense = out_dir()
    run(spark, ["add", write_text(M_SMALL), write_text(N_SMALL), dense, "--dense",
                "--rows", "4", "--cols", "3"])
    lines = read_tsv(spark, dense, "bi long, bj long, oi long, a string, b string, c string")
    assert lines[0] == (0, 0, 0, "123.634", "166.938", "66.278")


def test_groups(spark):
    g = write_text(GRAPH_SMALL)
    for extra in ([], ["--universe", "sources"], ["--universe", "endpoints", "--form", "pregel"]):
        out = out_dir()
        run(spark, ["groups", g, out] + extra)
        assert read_tsv(spark, out, "grp long, n long") == [(0, 3), (1, 7)]


def test_groups_go_on_in_their_folder(spark, tmp_path):
    chain = write_text([f"{k},{k + 1}" for k in range(8)])
    folder, out, again, fresh = str(tmp_path / "run"), out_dir(), out_dir(), out_dir()
    run(spark, ["groups", chain, out, "--rounds", "2", "--folder", folder])
    run(spark, ["groups", chain, again, "--folder", folder])
    run(spark, ["groups", chain, fresh])
    sizes = [read_tsv(spark, x, "grp long, n long") for x in (out, again, fresh)]
    assert sizes[1] == sizes[2] != sizes[0]
    assert sorted(os.listdir(folder)) == ["edges-light", "layout"] + [f"round-{k}" for k in range(6)]


def test_ratings(spark):
    r = write_text(RATINGS_SMALL)
    for mode in ("avg", "sql"):
        out = out_dir()
        run(spark, ["ratings", r, out, "--mode", mode])
        assert read_tsv(spark, out, "rating double, n long") == RATINGS_GOLDEN
