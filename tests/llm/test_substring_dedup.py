import random

import numpy as np
import pytest

from corvid.llm import fm_index, substring_dedup as S
from tests.llm.helpers import frame, prose, sha, white_words


def brute(rows, window=50):
    first = {}
    for doc_id, text in rows:
        w = white_words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = white_words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i:i + window])] < doc_id:
                gone |= set(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), sha(" ".join(kept))))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = S.substring_dedup(frame(spark, rows), **options).collect()
    return sorted((tuple(r) for r in got), key=str)


def awkward():
    passage, tail = prose(1, 70), prose(2, 55)
    return [(5, prose(3, 30) + " " + passage + " " + prose(4, 20)), (3, passage),
            (9, passage + "\n" + passage), (9, passage + "\n" + passage), (9, tail),
            (7, " ".join(passage.split()[:49])), (8, " ".join(passage.split()[:50])),
            (2, None), (1, ""), (4, " \t "), (None, passage), (None, None),
            (10, tail + " x " + passage[:200] + " " + tail), (11, "a " * 300), (12, "a " * 120),
            (13, prose(5, 4000) + " " + tail), (14, prose(5, 4000)), (15, passage.upper())]


def test_matches_brute_force(spark):
    rows = awkward()
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("hot", [0, 2])
def test_hot_anchors_and_random_mosaics(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rng = random.Random(hot)
    parts = [prose(100 + i, rng.randrange(20, 90), 50) for i in range(8)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 5)))) for i in range(40)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("hot", [0, 1000])
def test_passage_many_times_in_a_row(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    passage = prose(7, 55)
    rows = [(1, prose(8, 40) + " " + passage + " " + prose(9, 40)),
            (2, prose(10, 30) + f" {passage}" * 13 + " " + prose(11, 20)),
            (2, f"{passage} " * 3), (3, f"{passage} " * 5 + prose(12, 20))]
    assert run(spark, rows) == brute(rows)


def test_small_windows(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 40)))) for i in range(25)]
    assert run(spark, rows, window=7) == brute(rows, 7)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_blocks_of_a_long_document(spark, monkeypatch):
    ids = np.random.default_rng(1).integers(0, 1 << 62, 900).astype(np.uint64)
    def windows(found):
        return {(int(a), i) for a, s, e in zip(found[0], found[2], found[3])
                for i in range(s, e - 49)}
    whole = windows(S.segments_of(ids, 50))
    monkeypatch.setattr(S, "BLOCK", 100)
    assert windows(S.segments_of(ids, 50)) == whole and len(whole) == 851


def test_rows_keep_their_columns(spark):
    rows = awkward()
    docs = frame(spark, rows)
    left = S.remove_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    changed = {r["doc_id"]: r["text"] for r in left.where("doc_id in (3, 7, 8)").collect()}
    assert changed[3] == prose(1, 70) and changed[8] == "" and len(changed[7].split()) == 49


def test_index_against_brute_force():
    rng = np.random.default_rng(4)
    segments = [rng.integers(1, 4, rng.integers(8, 30)).astype(np.uint64) for _ in range(40)]
    owners = rng.integers(0, 10, 40)
    for (seg, owner), spans in zip(zip(segments, owners),
                                   fm_index.shared_spans(segments, owners, 8)):
        got = {i for a, b in spans for i in range(a, b)}
        want = set()
        for i in range(len(seg) - 7):
            if any(o < owner and any(np.array_equal(seg[i:i + 8], x[j:j + 8])
                                     for j in range(len(x) - 7))
                   for x, o in zip(segments, owners)):
                want |= set(range(i, i + 8))
        assert got == want


def test_wavelet_rank():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 11, 500)
    wavelet = fm_index.WaveletMatrix(text, 11)
    symbols, at = rng.integers(0, 11, 200), rng.integers(0, 501, 200)
    want = [int((text[:i] == c).sum()) for c, i in zip(symbols, at)]
    assert wavelet.rank(symbols, at).tolist() == want
