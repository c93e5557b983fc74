"""Write PLANS.md: the physical plans of the headline queries at sf0.1.

Adaptive queries are run first (their own plan, counted on the executors)
so the final adaptive plan is shown; a propagation round is shown as its own session plans it
(static, with the layout's partition count).
Usage: python dump_plans.py [sf_dir] [out]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corvid.operators import graph as G  # noqa: E402
from corvid.plans import bindings as B  # noqa: E402
from corvid.plans.queries import QUERIES  # noqa: E402
from corvid.session import local_session  # noqa: E402

SHOWN = ["mat_add_outer", "mat_add_blockjoin", "mat_add_blockjoin_checked", "mat_render_dense", "rating_hist_avg",
         "rating_hist_sql", "adjacency_to_edges"]


def _clean(plan: str) -> str:
    plan = plan.split("+- == Initial Plan ==")[0]
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    plan = re.sub(r"Location: [^,]+, ", "", plan)
    return "\n".join(line[:160] for line in plan.splitlines())


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else "PLANS.md"
    spark = local_session(cpus=8, shuffle_partitions=16)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corvid-plans-"))
    parts = ["# Physical plans", "",
             f"Generated by `dump_plans.py` on `{os.path.basename(sf_dir)}`, local[8], "
             "16 shuffle partitions. Expression ids, plan ids and file locations are "
             "stripped; long lines are cut at 160 characters.", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this plan, so the adaptive plan is final
        plan = qe.executedPlan().toString()
        parts += [f"## {name}", "", "```", _clean(plan), "```", ""]
    adj = B.order_adjacency(spark, sf_dir)
    edges = G.adjacency_to_edges(adj)
    for title, threshold in (("propagation round (no hot source)", G.HOT_EDGES),
                             ("propagation round (hot sources, threshold 5)", 5)):
        layout = G.layout_edges(edges, "src", threshold=threshold)
        G.run_rounds(layout, G.vertex_universe(adj, "all", layout.edges()), 1)
        rnd = G.propagation_round(layout, layout.tables.read("round-1", "id", G.LABELS))
        plan = rnd._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {title}", "", f"{layout.partitions} partitions; edges and labels "
                  "are bucketed tables.", "", "```", _clean(plan),
                  "```", ""]
    layout = G.layout_edges(edges, "src")
    labels = G.start_labels(G.vertex_universe(adj, "endpoints", layout.edges()), layout)
    step = G.pregel_round(layout, labels)
    plan = step._jdf.queryExecution().executedPlan().toString()
    parts += ["## Pregel superstep", "", f"{layout.partitions} partitions.", "",
              "```", _clean(plan), "```", ""]
    with open(out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
