"""Exact similarity links inside candidate components.

Members of a component are sets of 64-bit shingle hashes with a ``hint`` that
rules most pairs out cheaply (packed signatures, or prefixes). Small components
are searched in one task each, many to a task. Large ones are confirmed in two
rounds, whatever their size and shape:

1. some members (``HUBS`` of each component) are compared with all others,
   which are dealt to blocks of about ``BLOCK`` shingles; in a group of near
   copies this joins nearly all of them;
2. members outside a component's largest joined group are compared with all
   its members, block against block, so that no pair which could join two
   groups is left out. Pairs inside one group are not enumerated.

A task holds two blocks and an inverted index of one of them; it emits at most
one link for each member and each group of members it joins first. Nothing but
counts reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import join_sized, store
from corvid.llm.components import connected_components

MEMBERS = 300
WORDS = 1_000_000  # shingles of small components that one task searches
BLOCK = 250_000
HUBS = 8


class Postings:
    """Inverted index: token -> numbers of the arrays that hold it."""

    def __init__(self, arrays: list):
        import numpy as np

        self.count = len(arrays)
        sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
        flat = np.concatenate([*arrays, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.values, starts = np.unique(flat[order], return_index=True)
        self.bounds = np.append(starts, len(flat))
        self.owner = np.repeat(np.arange(len(arrays)), sizes)[order]

    def shared(self, tokens):
        """How many of ``tokens`` each array holds."""
        import numpy as np

        if not len(self.values):
            return np.zeros(self.count, np.int64)
        at = np.minimum(np.searchsorted(self.values, tokens), len(self.values) - 1)
        at = at[self.values[at] == tokens]
        counts = self.bounds[at + 1] - self.bounds[at]
        skip = np.repeat(self.bounds[at] - np.cumsum(counts) + counts, counts)
        return np.bincount(self.owner[skip + np.arange(len(skip))], minlength=self.count)


def is_linked(both, size, other, threshold):
    return threshold[1] * both >= threshold[0] * (size + other - both)


class Sets:
    """Some members, to find those linked with a set. ``hints`` makes, from
    the hints of the members, an object whose ``near(hint)`` gives the numbers
    of those that may be linked."""

    def __init__(self, shingles: list, hints, threshold):
        import numpy as np

        sets = [np.frombuffer(x, np.uint64) for x in shingles]
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.sets, self.index = sets, None
        self.hints, self.threshold = hints, threshold

    def linked(self, shingles: bytes, hint: bytes):
        import numpy as np

        near = self.hints.near(hint)
        if not len(near):
            return near
        own = np.frombuffer(shingles, np.uint64)
        if len(near) <= 4:
            both = np.array([np.count_nonzero(np.isin(self.sets[i], own, assume_unique=True))
                             for i in near.tolist()])
        else:
            self.index = self.index or Postings(self.sets)
            both = self.index.shared(own)[near]
        return near[is_linked(both, self.sizes[near], len(own), self.threshold)]


def _search(hints, threshold):
    """Roots (smallest cid of what hangs together) of whole components."""
    def run(frame):
        import numpy as np
        import pandas as pd

        cids, roots = [], []
        for _, part in frame.groupby("comp", sort=True):
            part = part.sort_values("cid")
            own, shingles, hint = (part[c].tolist() for c in ("cid", "shingles", "hint"))
            sets = Sets(shingles, hints(hint), threshold)
            root = np.full(len(own), -1)
            for i in range(len(own)):
                if root[i] >= 0:
                    continue
                root[i], reached = i, [i]
                while reached and (root < 0).any():
                    j = reached.pop()
                    found = sets.linked(shingles[j], hint[j])
                    found = found[root[found] < 0]
                    root[found] = i
                    reached += found.tolist()
            cids += own
            roots += [own[i] for i in root.tolist()]
        return pd.DataFrame({"node": np.array(cids, np.int64), "root": np.array(roots, np.int64)})

    return run


def _block_links(hints, threshold):
    """Links (a: member, b: probe) of one pair of blocks that connect what all
    its links connect. Members and probes of one root are joined already."""
    def run(frame):
        import numpy as np
        import pandas as pd

        probes, rest = frame[frame["probe"]], frame[~frame["probe"]]
        a, b = [], []
        if len(probes) and len(rest):
            sets = Sets(probes["shingles"].tolist(), hints(probes["hint"].tolist()), threshold)
            cids = probes["cid"].to_numpy()
            roots, of_probe = np.unique(probes["root"].to_numpy(), return_inverse=True)
            group = np.arange(len(roots))  # of each root of a probe
            joined: dict = {}  # groups that other roots have met
            at = {r: i for i, r in enumerate(roots.tolist())}
            for cid, root, shingles, hint in zip(*(rest[c].tolist() for c in
                                                   ("cid", "root", "shingles", "hint"))):
                own = int(group[at[root]]) if root in at else \
                    int(group[joined[root]]) if root in joined else -1
                found = sets.linked(shingles, hint)
                found = found[(cids[found] != cid) & (group[of_probe[found]] != own)]
                groups, first = np.unique(group[of_probe[found]], return_index=True)
                if not len(groups):
                    continue
                a += [cid] * len(first)
                b += cids[found[first]].tolist()
                group[np.isin(group, groups)] = groups[0] if own < 0 else own
                if root not in at:
                    joined.setdefault(root, int(of_probe[found[0]]))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def _blocks(members: DataFrame, probes: DataFrame, hints, threshold) -> DataFrame:
    """(a, b) links between ``probes`` and ``members`` (comp, root, cid, n,
    shingles, hint) of the same component, block against block."""
    def sized(rows, name):
        return rows.groupBy("comp").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / BLOCK))
                                        .cast("int").alias(name))

    counts = store(sized(members, "mb").join(sized(probes, "pb"), "comp"), "blocks")

    def dealt(rows, own, other, probe):
        rows = join_sized(rows, counts, "comp", "inner")
        return rows.select(
            "comp", F.pmod(F.xxhash64("cid"), F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other),
            "root", "cid", "shingles", "hint", F.lit(probe).alias("probe"))

    both = dealt(members, "mb", "pb", False).unionByName(dealt(probes, "pb", "mb", True))
    return (both.groupBy("comp", "mb", "pb")
            .applyInPandas(_block_links(hints, threshold), "a long, b long").distinct())


def confirm(members: DataFrame, hints, threshold: tuple[int, int],
            largest: int = MEMBERS) -> DataFrame:
    """Stored (node, root): members (comp, members, cid, n, shingles, hint, one
    row per cid, stored) that hang together by links inside their component."""
    small = members.where(F.col("members") <= largest)
    total = small.agg(F.sum("n")).first()[0] or 0
    bins = max(1, math.ceil(total / WORDS))
    roots = (small.withColumn("bin", F.pmod(F.xxhash64("comp"), F.lit(bins)))
             .select("bin", "comp", "cid", "shingles", "hint")
             .groupBy("bin").applyInPandas(_search(hints, threshold), "node long, root long"))
    large = members.where(F.col("members") > largest)
    if large.head(1):
        roots = roots.unionByName(_confirm_large(large, hints, threshold))
    return store(roots, "roots")


def _confirm_large(large: DataFrame, hints, threshold) -> DataFrame:
    alone = store(large.select("comp", F.col("cid").alias("root"), "cid", "n", "shingles", "hint"),
                  "large")
    spread = Window.partitionBy("comp").orderBy(F.xxhash64("cid"), "cid")
    picked = (alone.select("comp", "cid").withColumn("k", F.row_number().over(spread))
              .where(F.col("k") <= HUBS).select("cid"))
    hubs = join_sized(alone, store(picked, "hubs"), "cid", "left_semi")
    links = store(_blocks(alone, hubs, hints, threshold), "links")
    rooted = _rooted(alone, links)
    sizes = rooted.groupBy("comp", "root").agg(F.count("*").alias("size"))
    groups = store(sizes.groupBy("comp").agg(
        F.max(F.struct("size", "root"))["root"].alias("largest"), F.count("*").alias("groups"))
        .where("groups > 1").select("comp", "largest"), "groups")
    if groups.head(1):
        open_ = store(join_sized(rooted, groups, "comp", "inner"), "open")
        more = _blocks(open_.drop("largest"), open_.where("root <> largest").drop("largest"),
                       hints, threshold)
        links = store(links.unionByName(more), "links")
        rooted = _rooted(alone, links)
    return rooted.select(F.col("cid").alias("node"), "root")


def _rooted(alone: DataFrame, links: DataFrame) -> DataFrame:
    roots = store(connected_components(links), "roots")
    return (join_sized(alone.drop("root"), roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
            .withColumn("root", F.coalesce("root", "cid")))
