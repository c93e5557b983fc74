"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from corvid.llm import confirm, jaccard_join
from corvid.llm.components import connected_components
from tests.llm.helpers import frame, prose
from tests.llm.test_minhash import chain, edited, shingles


def brute(rows, least=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= least * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = jaccard_join.jaccard_join(frame(spark, rows), **options)
    return sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()),
                  key=str)


def awkward():
    base, other, passage = prose(1, 120), prose(2, 400), prose(3, 60)
    rows = [(20 + i, edited(base, i, 0.02)) for i in range(14)]
    rows += [(50 + i, edited(other, i, 0.015)) for i in range(14)]
    rows += [(80 + i, t) for i, t in enumerate(chain(15, 200, 12))]
    rows += [(200 + i, passage + " " + prose(300 + i, 10 + 3 * i)) for i in range(12)]
    rows += [(1000 + i, base) for i in range(10)]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "one two three"),
             (7, "\x0b"), (8, "a" * 5000), (9, " ".join(["same"] * 3000)),
             (10, " ".join(["same"] * 2000)), (11, prose(9, 30000, 50)), (None, base),
             (None, prose(77, 50)), (20, other), (20, other), (12, "straße ÄÖ x y z")]
    return rows


@pytest.mark.parametrize("options", [
    {}, {"limit": 2}, {"limit": 2, "largest": 3}, {"matches": 1}, {"often": 5, "limit": 3}])
def test_against_all_pairs(spark, options):
    rows = awkward()
    assert run(spark, rows, **options) == brute(rows)


def test_small_blocks_and_many_buckets(spark, monkeypatch):
    for module, name, value in ((jaccard_join, "PART", 400), (confirm, "BLOCK", 700),
                                (jaccard_join, "SEEN", 5)):
        monkeypatch.setattr(module, name, value)
    rows = awkward()
    assert run(spark, rows, limit=3, largest=2) == brute(rows)


def test_borderline_similarity(spark):
    # 80 of 100 and 79 of 100 shared shingles
    def text(shared, own, tag):
        return " ".join([f"s{i}" for i in range(shared + 4)] + [f"{tag}{i}" for i in range(own)])
    rows = [(1, text(80, 10, "a")), (2, text(80, 10, "b")), (3, "x " + text(79, 10, "c")[3:])]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_prefix_never_loses_a_partner():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(1, 60)
        f = np.sort(np.array([rng.choice([0, 2, 2, 50, 3000]) for _ in range(n)]))
        length, k = jaccard_join.prefix_length(f, n, (80, 100))
        least = -(-80 * n // 100)
        assert 1 <= k <= min(jaccard_join.MATCHES, least) and length == n - least + k <= n


def test_prefix_grows_where_candidates_are_costly():
    cheap = np.array([0] * 30 + [2] * 70)
    costly = np.array([40] * 100)
    assert jaccard_join.prefix_length(cheap, 100, (80, 100))[1] == 1
    assert jaccard_join.prefix_length(costly, 100, (80, 100))[1] > 1


def _members(spark, sets):
    rows = [(0, len(sets), i, len(s), bytearray(np.sort(np.array(s, np.uint64)).tobytes()),
             bytearray(np.append(np.uint64(1), np.sort(np.array(s, np.uint64))).tobytes()))
            for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "comp long, members long, cid long, n long, "
                                       "shingles binary, hint binary")


def test_one_component_of_unlinked_and_linked_classes(spark, monkeypatch):
    """Thousands of classes that share a shingle, a few of them linked: no pass
    but the two of ``confirm``, and no link lost."""
    monkeypatch.setattr(confirm, "BLOCK", 3000)
    sets = [[0] + [10 * i + j + 1 for j in range(9)] for i in range(2000)]
    sets += [s[:9] + [10 ** 6 + i] for i, s in enumerate(sets[::100])]  # 9 of 11: linked
    calls = []
    monkeypatch.setattr(confirm, "connected_components",
                        lambda e: calls.append(1) or connected_components(e))
    got = confirm.confirm(_members(spark, sets), jaccard_join.PrefixHints, (80, 100)).collect()
    root = {r["node"]: r["root"] for r in got}
    assert len(root) == len(sets) and len(calls) == 2
    for i in range(2000):
        assert root[i] == i
    for i in range(20):
        assert root[2000 + i] == 100 * i
