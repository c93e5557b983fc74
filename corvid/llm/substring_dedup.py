"""Substring deduplication with a compressed FM-index per shard.

A window is ``window`` consecutive words of one document; a word goes when it
lies in a window whose words also start in a document with a smaller id.

1. Anchors. Of the ``window - GRAM + 1`` grams of ``GRAM`` words in a window the
   smallest hash is its anchor, so equal windows have equal anchors. Consecutive
   windows with one anchor form a segment, of ``LONGEST`` windows at most (a
   repeated line has the same anchor all along). Anchors met in one document
   only are dropped.
2. Copies. Segments with the same words have the smallest document as their
   owner; in every other document all their words go. No search is needed.
3. Shards. What remains are different segments around one anchor. The owners'
   segments are dealt to shards by anchor; every shard builds an FM-index
   (wavelet matrix over the BWT) of its segments and streams them through it,
   searching backward: an interval is reported where at least ``window`` words
   match a segment of a smaller owner.
4. Hot anchors, with more than ``HOT`` different segments (a short passage
   common to many documents), would make an unbounded shard. Their segments
   are cut anew around longer anchors (``FINER``: grams of 35 and then of 50
   words, the window itself), which deals them to other, smaller shards: steps
   2 and 3 again. The last cut is into single windows, and those around a gram
   as long as the window are equal, so it ends in step 2 for any input.

Scale: no text is shuffled up to step 2, only (anchor, content, id, place); a
shard holds about ``SHARD`` words. Copies and windows are reduced in the map
tasks first. The joins back to the texts broadcast their small side only up
to a row bound and shuffle beyond.

Defined results: null, empty and word-less texts have no words and the digest
of the empty text; rows without an id keep all words and take none from
others; rows with one id never take words from each other; an empty table
gives no rows; other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import (WordIds, gram_hashes, join_sized, mix64, raw_bytes, slices,
                               small_batches, store, whole_row)
from corvid.llm.fm_index import shared_spans

GRAM = 20
FINER = (0.7, 1.0)  # shares of the window that finer anchors take
HOT = 1_000
HELD = 4 << 20  # bytes of words a task holds before it hands rows on
SHARD = 400_000
BLOCK = 1 << 22  # windows of one document handled at once
LONGEST = 64  # windows of a segment
ROWS = 1_000_000
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int):
    """Powers of an odd base modulo 2^64, and of its inverse."""
    import numpy as np

    with np.errstate(over="ignore"):
        inverse = pow(_BASE, -1, 1 << 64)
        out = []
        for base in (_BASE, inverse):
            p = np.full(n, base, np.uint64)
            p[:1] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        return out


class Digests:
    """64-bit digests of any parts of one sequence, from prefix sums."""

    table: tuple = (None, None)

    def __init__(self, ids):
        import numpy as np

        n = len(ids) + 1
        if Digests.table[0] is None or len(Digests.table[0]) < n:
            Digests.table = _powers(max(n, 1 << 16))
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n, np.uint64)
            np.cumsum(ids * Digests.table[0][:n - 1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start, end):
        import numpy as np

        with np.errstate(over="ignore"):
            raw = (self.sums[end] - self.sums[start]) * Digests.table[1][start]
            return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def segments_of(ids, window: int, gram: int = GRAM, longest: int = LONGEST):
    """(anchor, digest, start, end) arrays of the segments of one document,
    anchored by grams of ``gram`` words, of at most ``longest`` windows."""
    import numpy as np

    none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, int), np.empty(0, int)
    if len(ids) < window:
        return none
    gram = min(gram, window)
    grams, digests = gram_hashes(ids, gram), Digests(ids)
    width, parts = window - gram + 1, []
    for at in range(0, len(ids) - window + 1, BLOCK):
        least = grams[at:at + BLOCK + width - 1]
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least))
        cuts = -(-(last - first) // longest)  # pieces of each run
        run = np.repeat(np.arange(len(first)), cuts)
        piece = np.arange(len(run)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        begin = first[run] + longest * piece
        stop = np.minimum(begin + longest, last[run])
        parts.append((least[begin], at + begin, at + stop - 1 + window))
    anchor, start, end = (np.concatenate(x) for x in zip(*parts))
    return anchor, digests.of(start, end), start, end


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"),
                                      F.xxhash64(text).alias("row_key"), text.alias("text"))


def occurrences(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, content, doc_id, row_key, s, e) of every segment."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = WordIds()
        names = ["anchor", "content", "doc_id", "row_key", "s", "e"]
        for batch in slices(batches):
            parts = []
            for doc_id, key, data in zip(batch.column("doc_id").to_pylist(),
                                         batch.column("row_key").to_pylist(), raw_bytes(batch)):
                anchor, content, s, e = segments_of(known.of((data or b"").split()), window)
                if len(s):
                    parts.append((anchor.view(np.int64), content.view(np.int64),
                                  np.full(len(s), doc_id), np.full(len(s), key), s, e))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)], names)

    return texts.where("doc_id is not null").mapInArrow(
        run, "anchor long, content long, doc_id long, row_key long, s long, e long")


def _word_rows(texts: DataFrame, owned: DataFrame) -> DataFrame:
    """The words of every owned segment: (anchor, content, doc_id, hot, words)."""
    lists = store(owned.groupBy("doc_id", "row_key").agg(
        F.collect_list(F.struct("anchor", "content", "hot", "s", "e")).alias("parts")), "owned")

    def run(batches):
        known = WordIds()
        for batch in slices(batches, 64):
            rows = _Rows()
            for doc_id, data, parts in zip(batch.column("doc_id").to_pylist(), raw_bytes(batch),
                                           batch.column("parts").to_pylist()):
                ids = known.of((data or b"").split())
                for part in parts:
                    rows.add((part["anchor"], part["content"], doc_id, part["hot"]),
                             ids[part["s"]:part["e"]].tobytes())
                    if rows.size > HELD:
                        yield rows.batch()
            yield rows.batch()

    joined = join_sized(texts, lists, ["doc_id", "row_key"], "inner", ROWS, F.size("parts"))
    return joined.select("doc_id", "text", "parts").mapInArrow(run, WORDS)


WORDS = "anchor long, content long, doc_id long, hot boolean, words binary"


class _Rows:
    """Rows that a task holds back until they are ``HELD`` bytes."""

    def __init__(self, *_):
        self.keys, self.words, self.size = [], [], 0

    def add(self, key: tuple, words: bytes) -> None:
        self.keys.append(key)
        self.words.append(words)
        self.size += len(words) + 100

    def batch(self):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        out = pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k in self.keys], kind) for i, kind in enumerate(kinds)),
             pa.array(self.words, pa.binary())], ["anchor", "content", "doc_id", "hot", "words"])
        self.__init__()
        return out


def _search(window: int):
    def run(frame):
        import numpy as np
        import pandas as pd

        segments = [np.frombuffer(x, np.uint64) for x in frame["words"]]
        _, owners = np.unique(frame["doc_id"], return_inverse=True)
        spans = shared_spans(segments, owners, window)
        at = np.repeat(np.arange(len(frame)), [len(x) for x in spans])
        found = np.array([p for x in spans for p in x], np.int64).reshape(-1, 2)
        return pd.DataFrame({**{c: frame[c].to_numpy()[at] for c in ("anchor", "content", "doc_id")},
                             "rs": found[:, 0], "re": found[:, 1]})

    return run


FOUND = "anchor long, content long, doc_id long, rs long, re long"


def _owners(segments: DataFrame, place: str) -> DataFrame:
    """Stored (anchor, content, own, contents): of equal segments the one with
    the smallest document, and the number of different ones of its anchor."""
    owner = segments.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", *place.split())).alias("own"))
    spread = owner.groupBy("anchor").agg(F.count("*").alias("contents"))
    return store(owner.join(spread, "anchor"), "contents")


def _matched(rows: DataFrame, window: int) -> DataFrame:
    """Step 3 over segments (anchor, content, doc_id, words): ``FOUND``."""
    words = rows.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, math.ceil(words / 8 / SHARD))
    return (rows.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
            .select("shard", "anchor", "content", "doc_id", "words")
            .groupBy("shard").applyInPandas(_search(window), FOUND))


FINE = "anchor long, content long, doc_id long, at long, n long, a0 long, c0 long, words binary"


def _finer(rows: DataFrame, window: int, gram: int, longest: int) -> DataFrame:
    """Segments (anchor, content, doc_id, words, a0, c0, at) cut anew around
    grams of ``gram`` words; a0 and c0 name the segment of step 1 that they are
    part of, ``at`` is their place in it."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = [x.split()[0] for x in FINE.split(", ")]
        for batch in slices(batches, 1024):
            held: list = [[] for _ in names]
            for doc_id, words, a0, c0, base in zip(*(batch.column(c).to_pylist() for c in
                                                     ("doc_id", "words", "a0", "c0", "at"))):
                ids = np.frombuffer(words, np.uint64)
                anchor, content, s, e = segments_of(ids, window, gram, longest)
                for column, values in zip(held, (
                        anchor.view(np.int64).tolist(), content.view(np.int64).tolist(),
                        [doc_id] * len(s), (s + base).tolist(), (e - s).tolist(), [a0] * len(s),
                        [c0] * len(s), [ids[x:y].tobytes() for x, y in zip(s.tolist(), e.tolist())])):
                    column += values
                if 500 * len(held[0]) > HELD:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64() if name != "words" else pa.binary())
                         for x, name in zip(held, names)], names)
                    held = [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64() if name != "words" else pa.binary())
                 for x, name in zip(held, names)], names)

    return rows.select("doc_id", "words", "a0", "c0", "at").mapInArrow(run, FINE)


def _hot_matched(rows: DataFrame, window: int, hot: int) -> list[DataFrame]:
    """Step 4 for the segments (anchor, content, doc_id, words) of hot anchors:
    what is found, as tables of (a0, c0, doc_id, rs, re)."""
    found, more = [], rows.select("doc_id", "words", F.col("anchor").alias("a0"),
                                  F.col("content").alias("c0"), F.lit(0).cast("long").alias("at"))
    for i, share in enumerate(FINER):
        if not more.head(1):
            break
        last = i == len(FINER) - 1
        fine = store(_finer(more, window, max(GRAM, int(share * window)), 1 if last else LONGEST),
                     "finer")
        owners = _owners(fine, "words")
        named = owners.select("anchor", "content", F.col("own.doc_id").alias("first"),
                              (F.col("contents") > 1).alias("many"), (F.col("contents") > hot).alias("hot"))
        met = fine.drop("words").join(named, ["anchor", "content"])
        found.append(met.where("doc_id > first").select(
            "a0", "c0", "doc_id", F.col("at").alias("rs"), (F.col("at") + F.col("n")).alias("re")))
        if last:
            break
        own = owners.where("contents > 1").select(
            "anchor", "content", "own.doc_id", "own.words", (F.col("contents") > hot).alias("hot"))
        matched = store(_matched(own.where(~F.col("hot")), window), "matched")
        # the owner of a fine segment may have it in several segments of step 1
        mine = met.where("doc_id = first")
        found.append(mine.join(matched, ["anchor", "content", "doc_id"]).select(
            "a0", "c0", "doc_id", (F.col("at") + F.col("rs")).alias("rs"),
            (F.col("at") + F.col("re")).alias("re")))
        more = store(fine.join(named.where("hot"), ["anchor", "content"]).where("doc_id = first")
                     .select("doc_id", "words", "a0", "c0", "at"), "hotter")
    return found


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 50, hot: int | None = None) -> DataFrame:
    """(doc_id, row_key, s, e): word intervals that go; row_key is
    ``xxhash64(text)``. The intervals of a row may overlap."""
    hot = HOT if hot is None else hot
    texts = _texts(docs, id_col, text_col)
    found = occurrences(texts, window)
    shared = store(found.groupBy("anchor")
                   .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                   .where("low < high").select("anchor"), "anchors")
    met = store(join_sized(found, shared, "anchor", "inner", 2 * ROWS), "segments")
    contents = _owners(met, "row_key s e")
    copies = (met.join(contents.select("anchor", "content", F.col("own.doc_id").alias("first")),
                       ["anchor", "content"])
              .where("doc_id > first").select("doc_id", "row_key", "s", "e"))
    owned = (contents.where("contents > 1")
             .select("anchor", "content", (F.col("contents") > hot).alias("hot"), "own.*"))
    rows = store(_word_rows(texts, owned), "owners")
    found = _matched(rows.where(~F.col("hot")), window)
    for part in _hot_matched(rows.where("hot"), window, hot):
        found = found.unionByName(part.toDF("anchor", "content", "doc_id", "rs", "re"))
    # the owner may have its segment in several places
    owners = met.join(found, ["anchor", "content", "doc_id"]).select(
        "doc_id", "row_key", (F.col("s") + F.col("rs")).alias("s"),
        (F.col("s") + F.col("re")).alias("e"))
    return copies.unionByName(owners)


def _joined(batches):
    """Sorted intervals of each row, with those that meet made one."""
    import pyarrow as pa

    for batch in slices(batches, 1024):
        out = []
        for spans in batch.column("spans").to_pylist():
            joined: list = []
            for x in spans:
                if joined and x["s"] <= joined[-1]["e"]:
                    joined[-1]["e"] = max(joined[-1]["e"], x["e"])
                else:
                    joined.append({"s": x["s"], "e": x["e"]})
            out.append(joined)
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(out, kind)],
            ["doc_id", "row_key", "spans"])


def _with_spans(docs: DataFrame, id_col: str, text_col: str, window: int, *more) -> DataFrame:
    lists = (repeated_spans(docs, id_col, text_col, window).groupBy("doc_id", "row_key")
             .agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans")))
    spans = store(lists.mapInArrow(_joined, lists.schema), "spans")
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), "spans")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("__id"),
                        F.xxhash64(text).alias("__key"), text.alias("text"), *more)
    return join_sized(texts, spans, ["__id", "__key"], "left", ROWS, F.size("spans"))


def kept_words(data: bytes | None, spans) -> tuple[list[bytes], int, int]:
    """(words that stay, words, words that go)."""
    import numpy as np

    words = (data or b"").split()
    if spans is None or not len(spans):
        return words, len(words), 0
    stays = np.ones(len(words), bool)
    for x in spans:
        stays[x["s"]:x["e"]] = False
    kept = [w for w, s in zip(words, stays.tolist()) if s]
    return kept, len(words), len(words) - len(kept)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 50, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (and kept_text)."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in slices(batches):
            rows = []
            for doc_id, data, spans in zip(batch.column("__id").to_pylist(), raw_bytes(batch),
                                           batch.column("spans").to_pylist()):
                kept, n, gone = kept_words(data, spans)
                text = b" ".join(kept)
                rows.append((doc_id, n, gone, hashlib.sha256(text).hexdigest(),
                             text.decode() if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
            size = 4 + with_text
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kinds[i]) for i in range(size)], names[:size])

    return _with_spans(docs, id_col, text_col, window).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
        + ", kept_text string" * with_text)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 50) -> DataFrame:
    """All rows of ``docs`` with the repeated words taken out of the text: a
    text that loses words becomes its kept words joined by one space (empty if
    none is left), the others stay as they are."""
    @F.arrow_udf("string", F.ArrowUDFType.SCALAR)
    def cut(texts, spans):
        import pyarrow as pa

        out: list = []
        for i in range(0, len(texts), 256):
            out += [t if s is None else b" ".join(kept_words(t.encode(), s)[0]).decode()
                    for t, s in zip(texts.slice(i, 256).to_pylist(),
                                    spans.slice(i, 256).to_pylist())]
        return pa.array(out, pa.string())

    rows = _with_spans(docs, id_col, text_col, window,
                       whole_row(docs).alias("row"))
    rows = rows.withColumn("text", cut("text", "spans"))
    return rows.select(*[F.col("text").alias(c) if c == text_col
                         else F.col("row").getField(c).alias(c) for c in docs.columns])
