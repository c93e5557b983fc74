import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corvid.llm import packing as P
from tests.llm.helpers import frame, prose


def check(rows, got, capacity):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                 for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_and_places(spark):
    rows = [(1, None), (2, ""), (3, "It's a test <|endoftext|> here"), (4, prose(1, 3000)),
            (4, prose(1, 3000)), (None, "none"), (None, "none"), (2 ** 60 + 1, " \n\n é 日本"),
            (6, "a" * 5000)] + [(100 + i, prose(i, 5 + i)) for i in range(60)]
    got = P.pack_documents(frame(spark, rows), capacity=128).collect()
    n = check(rows, got, 128)
    assert n <= -(-sum(r["length"] for r in got) // 128) + 2


def test_empty_table(spark):
    assert P.pack_documents(frame(spark, [])).count() == 0


def test_ids_are_returned(spark):
    got = P.pack_documents(frame(spark, [(1, "hello world")]), with_ids=True).first()
    assert zlib.crc32(np.array(got["ids"], "<u4").tobytes()) == got["ids_crc32"]


def test_groups_are_bounded(spark):
    pieces = P.token_pieces(frame(spark, [(i, prose(i, 20)) for i in range(50)]))
    from corvid.llm.common import store
    got = P.best_fit(store(pieces, "t"), group=10).collect()
    assert len({r["sequence_id"] >> 32 for r in got}) > 1
    check([(i, prose(i, 20)) for i in range(50)], got, 1024)


@pytest.mark.parametrize("seed", range(5))
def test_fit_is_best_fit(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randrange(1, 65) for _ in range(300)), reverse=True)
    sequences, offsets = P.fit(lengths, 64)
    rooms = []
    for length, s, o in zip(lengths, sequences, offsets):
        fits = [r for r in rooms if r >= length]
        if fits:
            assert rooms[s] == min(fits) and o == 64 - rooms[s]
        else:
            assert s == len(rooms) and o == 0
            rooms.append(64)
        rooms[s] -= length
