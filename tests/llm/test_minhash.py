import functools
import random

import numpy as np
import pytest

from corvid.llm import components, confirm
from corvid.llm import minhash as M
from corvid.llm.components import connected_components
from tests.llm.helpers import frame, lower_ascii, prose, white_words


def shingles(text):
    w = white_words(lower_ascii(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((doc_id, len(sets[i]), low, doc_id == low))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = M.near_duplicates(frame(spark, rows), **options).drop("row_key").collect()
    return sorted((tuple(r) for r in got), key=str)


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"z{rng.randrange(10 ** 6)}" if rng.random() < share else w
                    for w in text.split())


def chain(n, size=200, step=8):
    """Texts linked with their neighbours only."""
    words = [f"c{i}" for i in range(size + n * step)]
    return [" ".join(words[i * step:i * step + size]) for i in range(n)]


def awkward():
    base, other = prose(1, 300), prose(2, 400)
    rows = [(20 + i, edited(base, i, 0.01)) for i in range(12)]
    rows += [(50 + i, edited(other, i, 0.02)) for i in range(12)]
    rows += [(80 + i, t) for i, t in enumerate(chain(15))]
    return rows + [(1, None), (2, ""), (3, "  "), (4, "one two"), (5, "ONE two"), (6, "one"),
                   (7, base), (7, base), (7, other), (None, base), (None, prose(9, 50)),
                   (None, prose(9, 50)), (9, prose(8, 6000)), (8, prose(8, 6000) + " end"),
                   (10, "a " * 900), (11, "a " * 30)]


def test_matches_brute_force(spark):
    rows = awkward()
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("bucket,largest", [(2, 300), (4000, 3), (2, 3)])
def test_hot_buckets_and_large_components(spark, bucket, largest):
    rows = awkward()
    assert run(spark, rows, bucket=bucket, largest=largest) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(confirm, "BLOCK", 400)
    rows = [(i, t) for i, t in enumerate(chain(9))] + awkward()
    assert run(spark, rows, bucket=2, largest=2) == brute(rows)


def test_one_band_key_of_unlinked_classes(spark, monkeypatch):
    """20,000 classes share all band keys and none is linked: components are
    taken twice (candidates, hubs) and once more, whatever their number."""
    n, calls = 20_000, []
    monkeypatch.setattr(confirm, "connected_components",
                        lambda e: calls.append(1) or connected_components(e))
    rng = np.random.default_rng(2)
    sets = np.sort(rng.integers(0, 1 << 63, (n, 6), np.uint64), axis=1)
    sigs = rng.integers(0, 1 << 63, (n, M.HASHES // 16), np.uint64)
    rows = [(0, n, i, 6, bytearray(sigs[i].tobytes()), bytearray(sets[i].tobytes())) for i in range(n)]
    members = spark.createDataFrame(rows, "comp long, members long, cid long, n long, hint binary, "
                                          "shingles binary")
    got = confirm.confirm(members, functools.partial(M.SignatureHints, 0.7), (85, 100))
    assert got.where("node = root").count() == got.count() == n and len(calls) == 2


def test_empty_table(spark):
    assert run(spark, []) == []


def test_drop_keeps_one_of_each_group(spark):
    rows = [(1, prose(1, 90)), (2, prose(1, 90)), (3, prose(2, 90)), (4, None)]
    docs = frame(spark, rows)
    left = M.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4]


def test_threshold_of_the_pipeline(spark):
    import corpus_pipeline as C
    rows = []
    for k in range(20):  # 100 shingles each; 90 shared is 0.818, 88 is 0.786
        text = [f"t{k}x{i}" for i in range(104)]
        rows += [(10 * k + j, " ".join(text[:n] + [f"o{k}x{i}x{j}" for i in range(104 - n)]))
                 for j, n in enumerate([104, 94 if k % 2 else 92])]
    docs = frame(spark, rows)
    left = {r["doc_id"] for r in C.near_dedup(spark, docs, "").collect()}
    assert left == {d for d, _ in rows if d % 10 == 0 or d // 10 % 2 == 0}
    assert M.near_duplicates(docs).where("not kept").count() == 0
    assert M.shape((85, 100))[:2] == (5, 22) and M.shape((8, 10))[:2] == (4, 28)


def test_estimate_is_near_the_similarity():
    seed, rng = M.seeds(), np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(20):
            both = rng.integers(0, 1 << 63, int(1000 * share), np.uint64)
            a, b = (np.concatenate([both, rng.integers(0, 1 << 63, 1000 - len(both), np.uint64)])
                    for _ in range(2))
            true = len(both) / (2000 - len(both))
            errors.append(float(M.estimate(M.pack(M.minima(a, seed)), M.pack(M.minima(b, seed)))) - true)
        assert abs(np.mean(errors)) < 0.03


@pytest.mark.parametrize("least", [500, 1])
def test_components(spark, monkeypatch, least):
    monkeypatch.setattr(components, "LEAST", least)
    edges = [(i, i + 1) for i in range(1, 30)] + [(40, 41), (41, 40), (50, 50), (60, 45), (45, 61)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert roots == {**{i: 1 for i in range(1, 31)}, 40: 40, 41: 40, 60: 45, 45: 45, 61: 45}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_in_chunks(monkeypatch):
    """Stars of a task's edges, also when a node's edges fall into several chunks."""
    import pyarrow as pa
    rng = random.Random(5)
    for chunk in (1, 4, 500_000):
        monkeypatch.setattr(components, "CHUNK", chunk)
        edges = sorted((max(x), min(x)) for x in ((rng.randrange(60), rng.randrange(60))
                                                  for _ in range(50)) if x[0] != x[1])
        batches = [pa.RecordBatch.from_pydict({"a": [x[0] for x in edges[i:i + 3]],
                                               "b": [x[1] for x in edges[i:i + 3]]})
                   for i in range(0, len(edges), 3)]
        out = [(r["a"], r["b"]) for x in components._forests(batches) for r in x.to_pylist()]

        def roots(pairs):
            low = {x: x for p in edges for x in p}
            for _ in low:
                for a, b in pairs:
                    low[a] = low[b] = min(low[a], low[b])
            return low
        assert roots(out) == roots(edges) and all(a > b for a, b in out)
        assert chunk < 100 or dict(out) == {k: v for k, v in roots(edges).items() if k != v}


def test_components_take_few_jobs(spark):
    """Links like those of one large group (members of eight hubs, one hub
    below the next): every job costs the driver memory."""
    edges = [(100 + i, 10 + i % 8) for i in range(2000)] + [(100 + i, 10 + i % 7) for i in range(2000)] \
        + [(11 + k, 10 + k) for k in range(7)]
    sc = spark.sparkContext
    sc.setJobGroup("components", "components")
    try:
        roots = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(roots) == 2008 and {r["root"] for r in roots} == {10}
    assert len(sc.statusTracker().getJobIdsForGroup("components")) <= 30
