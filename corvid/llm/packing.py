"""Best-fit-decreasing packing of token sequences.

``token_pieces`` tokenises whole texts, ends each document with ``end_id`` and
cuts only documents longer than the capacity: into pieces of exactly
``capacity`` tokens, the first of which may be shorter. ``best_fit`` packs the
pieces: longest first, each into the open sequence with the least remaining
room that still holds it. A segment tree over the remaining capacities finds
that sequence in O(log capacity) per piece.

Scale: pieces are dealt evenly into groups of about ``GROUP`` pieces (by row
number, so no document or repeated id can make a group hot) and each group is
packed alone, in bounded memory. What is lost against one global packing is
at most the open sequences a group ends with, one or two of many thousands.

Defined results: a null or empty text is the document ``[end_id]``; rows with
a null or repeated id are documents of their own; an empty table gives no
rows; ties in length are packed in the order of (doc_id, piece).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import slices, store, text_frame

GROUP = 65_536
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class Encoder:
    """Ids of ``byte_bpe_50k.json`` without special tokens added.

    The same vocabulary as merge ranks gives the same ids several times
    faster; a text that spells a special token out is left to the tokenizer
    file itself, which maps the spelling to the special id.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import public_tokenizers

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str):
        import numpy as np

        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)


_ENCODERS: dict = {}


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = 1024, end_id: int = 2, paths: tuple | None = None,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves (``array<long>``)."""

    def cut(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        where = paths or default_paths()
        if where not in _ENCODERS:
            _ENCODERS[where] = Encoder(*where)
        encode = _ENCODERS[where]
        end = np.array([end_id], "<u4")
        for batch in slices(batches):
            rows = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist()):
                ids = np.concatenate([encode(text or ""), end])
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(piece)
                    rows["start"].append(a)
                    rows["length"].append(b - a)
                    rows["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        rows["ids"].append(ids[a:b].astype("int64"))
            kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int64())}
            names = [k for k in rows if with_ids or k != "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[k], kinds.get(k, pa.int64())) for k in names], names)

    return text_frame(docs, id_col, text_col).mapInArrow(
        cut, PIECES + ", ids array<long>" * with_ids)


class OpenBins:
    """Open sequences by remaining room, under a segment tree of counts."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        at = room + self.leaves
        while at:
            self.tree[at] += 1
            at >>= 1

    def tightest(self, length: int) -> int:
        """The least room >= ``length`` of an open sequence, or -1."""
        tree, at = self.tree, length + self.leaves
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < self.leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        return at - self.leaves

    def take(self, room: int) -> int:
        at = room + self.leaves
        while at:
            self.tree[at] -= 1
            at >>= 1
        return self.bins[room].pop()


def fit(lengths, capacity: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each length, in the given (decreasing) order."""
    open_bins, sequences, offsets, count = OpenBins(capacity), [], [], 0
    for length in lengths:
        room = open_bins.tightest(length)
        if room < 0:
            number, room, count = count, capacity, count + 1
        else:
            number = open_bins.take(room)
        sequences.append(number)
        offsets.append(capacity - room)
        if room > length:
            open_bins.add(room - length, number)
    return sequences, offsets


def best_fit(pieces: DataFrame, capacity: int = 1024, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored ``pieces`` (read twice)."""
    from pyspark.sql.types import LongType, StructField, StructType

    groups = max(1, math.ceil(pieces.count() / group))
    # row numbers of a stored table: the same on a re-read, and never hot;
    # pandas has no null integer, so a flag carries a missing id
    dealt = (pieces.withColumn("__group", F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        .withColumn("__no_id", F.col("doc_id").isNull())
        .withColumn("doc_id", F.coalesce("doc_id", F.lit(0))))

    def pack(frame):
        number = int(frame["__group"].iloc[0])
        frame = frame.drop(columns="__group").sort_values(
            ["length", "__no_id", "doc_id", "piece"], ascending=[False, True, True, True],
            kind="stable")
        sequences, offsets = fit(frame["length"].tolist(), capacity)
        frame["sequence_id"] = [(number << 32) + s for s in sequences]
        frame["offset"] = offsets
        return frame

    schema = StructType([*dealt.drop("__group").schema, StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])
    return (dealt.groupBy("__group").applyInPandas(pack, schema)
            .withColumn("doc_id", F.when(~F.col("__no_id"), F.col("doc_id"))).drop("__no_id"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 1024, end_id: int = 2, paths: tuple | None = None,
                   with_ids: bool = False) -> DataFrame:
    pieces = token_pieces(docs, id_col, text_col, capacity, end_id, paths, with_ids)
    return best_fit(store(pieces, "pieces"), capacity)
