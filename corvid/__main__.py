"""Command line: the three workloads from text files to tab-separated text.

    spark-submit -m corvid add M_PATH N_PATH OUT [--how outer|inner] ...
    spark-submit -m corvid groups GRAPH_PATH OUT [--universe all|sources|endpoints] [--folder DIR] ...
    spark-submit -m corvid ratings RATINGS_PATH OUT [--mode avg|sql]

(or ``python -m corvid ...`` for a local run). The master, the shuffle
partitions and the shared ``spark.checkpoint.dir`` come from the
submitting environment. Output folders hold one part file per task.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from corvid.operators import graph as G
from corvid.operators import matrix as M
from corvid.operators import ratings as R
from corvid.sources import (read_cells, read_links, read_ratings, write_delimited,
                            write_lines)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corvid")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("add", help="block addition of two sparse matrices")
    a.add_argument("m")
    a.add_argument("n")
    a.add_argument("out")
    a.add_argument("--how", choices=("outer", "inner"), default="outer")
    a.add_argument("--on-duplicate", choices=M.DUPLICATE_POLICIES, default="error")
    a.add_argument("--rows", type=int, default=M.ROWS)
    a.add_argument("--cols", type=int, default=M.COLS)
    a.add_argument("--dense", action="store_true",
                   help="write dense block rows (bi, bj, oi, values) instead of cells")

    g = sub.add_parser("groups", help="group sizes after min-label propagation")
    g.add_argument("graph")
    g.add_argument("out")
    g.add_argument("--universe", choices=G.UNIVERSES, default="all")
    g.add_argument("--rounds", type=int, default=G.ROUNDS)
    g.add_argument("--parse", choices=("strict", "prefix"), default="strict")
    g.add_argument("--form", choices=("union", "pregel"), default="union",
                   help="pregel: triplet form over edge endpoints")
    g.add_argument("--folder", help="keep every round's labels in this shared folder; a run "
                                    "that was cut off goes on from its last finished round")

    r = sub.add_parser("ratings", help="histogram of users by truncated mean rating")
    r.add_argument("ratings")
    r.add_argument("out")
    r.add_argument("--mode", choices=("avg", "sql"), default="avg")
    return p


def run(spark: SparkSession, argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    if args.cmd == "add":
        blocks = M.matrix_add(read_cells(spark, args.m), read_cells(spark, args.n),
                              how=args.how, on_duplicate=args.on_duplicate,
                              rows=args.rows, cols=args.cols)
        if args.dense:
            # the rendered row already holds tabs: written as plain text lines
            write_lines(M.render_dense(blocks, args.rows, args.cols), args.out, sep="\t")
            return
        result = blocks
    elif args.cmd == "groups":
        adj = read_links(spark, args.graph, mode=args.parse)
        pregel = args.form == "pregel"
        if pregel and args.universe != "endpoints":
            raise SystemExit("--form pregel counts edge endpoints: use --universe endpoints")
        if args.folder and G.started(spark, args.folder):
            labels = G.resume(spark, args.folder, args.rounds,
                              G.pregel_round if pregel else G.propagation_round)
        elif pregel:
            labels = G.pregel_min(G.adjacency_to_edges(adj), args.rounds, folder=args.folder)
        else:
            labels = G.min_label_groups(adj, args.universe, args.rounds, folder=args.folder)
        result = G.group_sizes(labels)
    else:
        mode = "typed" if args.mode == "avg" else "raw"
        result = R.rating_histogram(read_ratings(spark, args.ratings, mode=mode), mode=args.mode)
    write_delimited(result, args.out)


def main(argv: list[str] | None = None) -> None:
    spark = (SparkSession.builder.appName("corvid")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             # delete the checkpoint files of rounds nothing refers to any more
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .getOrCreate())
    run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    main()
