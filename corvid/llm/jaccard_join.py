"""N-gram Jaccard join with adaptive multi-match prefixes.

1. A document's set is its distinct shingles of ``SHINGLE`` words (one shingle
   if it is shorter). Documents with equal sets are one class.
2. Shingles are counted over the whole corpus in sorted runs (``frequencies``).
   All sets are put in one global order: shingles met more than ``limit`` times
   by their count, the others before them by their hash.
3. Of a set of ``n`` shingles a partner shares ``t = ceil(threshold * n)`` or
   more, hence ``k`` or more of the first ``n - t + k``: the prefix of match
   count ``k``. Every class picks the ``k`` that its prefix makes cheapest:
   a longer prefix meets more postings, of which fewer pairs stay candidates,
   since ``k`` matches are asked for (``prefix_length``). Two linked classes
   share at least the smaller of their ``k`` in their prefixes.
4. Postings of the shingles met at most ``limit`` times are dealt to buckets;
   pairs of compatible size in one posting list (never more than ``limit``
   long) are counted, first in the buckets, then over them, and pairs with
   too few matches go. Longer lists are never paired: their classes hang on
   the smallest one, and what a pair may match there is taken off its count.
5. Candidates that hang together are confirmed by ``confirm``: once more by
   matches in both whole prefixes, then on full sets, in bounded blocks.

A pair with the threshold's similarity is never lost (the prefix bound is
exact); what is reported linked is exact, up to 64-bit hashes of words and
shingles and 63-bit hashes of sets.

Scale: no text is shuffled. Counting moves eight bytes a shingle, postings
about a fifth of the shingles that occur more than once at all (a bitmap of at
most ``BITS`` says so). At most ``OFTEN`` counted shingles reach the driver:
``limit`` rises from ``LIMIT`` until no more are above it.

Defined results: null, empty and word-less texts have no shingle and are linked
with nothing; rows without an id belong to their component, which is named by
its smallest id (null if it has none); rows that share an id keep their own
sets; an empty table gives no rows; other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import (NO_ID, WordIds, gram_hashes, join_sized, raw_bytes, slices,
                               small_batches, store)
from corvid.llm.components import connected_components
from corvid.llm.confirm import Postings, confirm

SHINGLE = 5
THRESHOLD = (80, 100)
LIMIT = 16
OFTEN = 1 << 20
BITS = 1 << 27
MATCHES = 8  # largest match count of a prefix
PART = 2_000_000  # entries of a bucket, and of a task's buffer
SEEN = 300_000  # sets a task remembers, to pass copies over
WIDE = 1_000_000


def shingle_set(data: bytes | None, known: WordIds, size: int = SHINGLE):
    """Sorted distinct 64-bit shingle hashes of a text."""
    import numpy as np

    words = (data or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(known.of(words), min(size, len(words))))


def set_id(shingles) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(shingles.tobytes()) >> 1


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"),
                                      F.xxhash64(text).alias("row_key"), text.alias("text"))


def set_rows(texts: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_shingles, cid) per row; cid null without shingles."""
    def run(batches):
        import pyarrow as pa

        known = WordIds()
        for batch in slices(batches):
            sizes, cids = [], []
            for data in raw_bytes(batch):
                found = shingle_set(data, known)
                sizes.append(len(found))
                cids.append(set_id(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()),
                 pa.array(cids, pa.int64())], ["doc_id", "row_key", "n_shingles", "cid"])

    return texts.mapInArrow(run, "doc_id long, row_key long, n_shingles long, cid long")


class Fresh(set):
    """Sets met before in this task; forgets all when too large."""

    def first(self, cid: int) -> bool:
        if cid in self:
            return False
        if len(self) >= SEEN:
            self.clear()
        self.add(cid)
        return True


# ------------------------------------------------------------ frequencies


class Frequencies:
    """What tasks know of the corpus: ``repeated`` (a bitmap over the high bits
    of a hash: may it occur more than once?), the shingles met more than
    ``limit`` times (sorted) and their counts."""

    def __init__(self, bits: int, repeated, often, counts, limit: int):
        self.shift, self.repeated = 64 - (bits.bit_length() - 1), repeated
        self.often, self.counts, self.limit = often, counts, limit

    def of(self, shingles):
        """Estimated number of sets with each shingle: 0 for one of its own,
        2 for one that repeats, the count for one met more often."""
        import numpy as np

        bit = shingles >> np.uint64(self.shift)
        byte = self.repeated[(bit >> np.uint64(3)).astype(np.int64)]
        out = ((byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(np.int64) * 2
        if len(self.often):
            at = np.minimum(np.searchsorted(self.often, shingles), len(self.often) - 1)
            hit = self.often[at] == shingles
            out[hit] = self.counts[at[hit]]
        return out


def _counted(tokens, counts):
    """Distinct tokens and their summed counts."""
    import numpy as np

    order = np.argsort(tokens)
    tokens, counts = tokens[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    return tokens[first], np.add.reduceat(counts, first)


def frequencies(texts: DataFrame, total: int, limit: int = LIMIT, often: int = OFTEN) -> Frequencies:
    """Counts over all rows (copies met in one task count once). ``total`` is
    the number of shingles of all rows."""
    import numpy as np

    bits = min(BITS, max(1 << 16, 1 << (4 * total).bit_length()))
    buckets = min(bits // 8, 1 << max(0, math.ceil(math.log2(max(1, total) / PART))))
    high = buckets.bit_length() - 1  # a bucket is a range of hashes
    shift = np.uint64(64 - (bits.bit_length() - 1))

    def sort_runs(batches):
        import pyarrow as pa

        known, fresh = WordIds(), Fresh()

        def packed(held):
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.empty(0, np.int64)
            if high:
                cuts = np.searchsorted(tokens, np.arange(1, buckets, dtype=np.uint64)
                                       << np.uint64(64 - high))
            parts = [(i, t, c) for i, (t, c) in enumerate(zip(np.split(tokens, cuts),
                                                               np.split(counts, cuts))) if len(t)]
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _, _ in parts], pa.int64()),
                 pa.array([t.tobytes() for _, t, _ in parts], pa.binary()),
                 pa.array([c.astype(np.uint32).tobytes() for _, _, c in parts], pa.binary())],
                ["bucket", "tokens", "counts"])

        held, size = [], 0
        for batch in slices(batches):
            for data in raw_bytes(batch):
                found = shingle_set(data, known)
                if len(found) and fresh.first(set_id(found)):
                    held.append(found)
                    size += len(found)
                    if size >= PART:
                        yield packed(held)
                        held, size = [], 0
        if held:
            yield packed(held)

    def reduce_bucket(frame):
        import pandas as pd

        tokens, counts = _counted(
            np.concatenate([np.frombuffer(x, np.uint64) for x in frame["tokens"]]),
            np.concatenate([np.frombuffer(x, np.uint32) for x in frame["counts"]]).astype(np.int64))
        tokens, counts = tokens[counts > 1], counts[counts > 1]
        bucket, step = int(frame["bucket"].iloc[0]), bits // buckets
        mark = np.zeros(step, np.uint8)
        mark[(tokens >> shift).astype(np.int64) - bucket * step] = 1
        some = np.flatnonzero(counts > limit)
        return pd.DataFrame({
            "bucket": bucket, "bits": [np.packbits(mark, bitorder="little").tobytes()] + [None] * len(some),
            "token": pd.array([None, *tokens[some].view(np.int64).tolist()], "Int64"),
            "n": pd.array([None, *counts[some].tolist()], "Int64")})

    runs = texts.select("text").mapInArrow(sort_runs, "bucket long, tokens binary, counts binary")
    found = store(runs.groupBy("bucket").applyInPandas(
        reduce_bucket, "bucket long, bits binary, token long, n long"), "frequencies")
    repeated = np.zeros(bits // 8, np.uint8)  # at most BITS / 8 bytes
    for r in found.where("bits is not null").select("bucket", "bits").toLocalIterator():
        own = np.frombuffer(r["bits"], np.uint8)
        at = r["bucket"] * len(own)
        repeated[at:at + len(own)] = own
    above = found.where("token is not null")
    # how many are met how often, by eighths of a power of two: 512 rows at most
    level = F.floor(8 * F.log2("n")).alias("level")
    levels = sorted(((r["level"], r["count"]) for r in above.groupBy(level).count().collect()),
                    reverse=True)
    room = often
    for step, count in levels:
        room -= count
        if room < 0:
            limit = max(limit, math.ceil(2 ** ((step + 1) / 8)))
            break
    rows = above.where(F.col("n") > limit).select("token", "n").toPandas()  # at most `often`
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return Frequencies(bits, repeated, tokens[order], rows["n"].to_numpy(np.int64)[order], limit)


# ------------------------------------------------------------ prefixes


def prefix_length(estimates, n: int, threshold: tuple[int, int], matches: int = MATCHES,
                  weight: int = 8) -> tuple[int, int]:
    """(length, match count) of the cheapest prefix. ``estimates`` are the
    posting lengths of the set's shingles in the global order: a prefix meets
    their sum, and of the sets met at most the sum over the match count have
    enough matches to be verified, at ``weight`` times the cost of a meeting."""
    import numpy as np

    least = -(-threshold[0] * n // threshold[1])
    k = np.arange(1, min(matches, least) + 1)
    met = np.cumsum(estimates[:n - least + k[-1]])[n - least + k - 1]
    best = int(np.argmin(met * (1 + weight / k)))
    return n - least + int(k[best]), int(k[best])


def prefix(shingles, known: Frequencies, threshold: tuple[int, int], matches: int = MATCHES):
    """(shingles of the prefix that repeat, their estimates, match count)."""
    import numpy as np

    estimates = known.of(shingles)
    order = np.lexsort((shingles, estimates))
    length, k = prefix_length(estimates[order], len(shingles), threshold, matches)
    order = order[:length]
    order = order[estimates[order] > 0]
    return shingles[order], estimates[order], k


def postings(texts: DataFrame, known: Frequencies, threshold: tuple[int, int], matches: int,
             buckets: int) -> DataFrame:
    """Packed postings (bucket, tokens, cids, sizes, ks, longs) of prefixes; in
    bucket -1 those of the long lists. ``ks`` are the classes' match counts,
    ``longs`` how many of their prefix's shingles have long lists."""
    high = buckets.bit_length() - 1
    kinds = ("uint64", "int64", "int64", "int16", "int64")
    names = ["bucket", "tokens", "cids", "sizes", "ks", "longs"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def packed(held):
            columns = [np.concatenate(x).astype(kind) for x, kind in zip(zip(*held), kinds)]
            rare = columns[4] >= 0
            place = (columns[0] >> np.uint64(64 - high)).astype(np.int64) if high \
                else np.zeros(len(rare), np.int64)
            place[~rare] = -1
            columns[4] = np.abs(columns[4]) - 1
            order = np.argsort(place, kind="stable")
            place = place[order]
            at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            parts = [np.split(x[order], at[1:]) for x in columns]
            return pa.RecordBatch.from_arrays(
                [pa.array(place[at]), *[pa.array([x.tobytes() for x in part], pa.binary())
                                        for part in parts]], names)

        sets, fresh, held, size = WordIds(), Fresh(), [], 0
        for batch in slices(batches):
            for data in raw_bytes(batch):
                found = shingle_set(data, sets)
                if not len(found):
                    continue
                cid = set_id(found)
                if not fresh.first(cid):
                    continue
                tokens, estimates, k = prefix(found, known, threshold, matches)
                if not len(tokens):
                    continue
                long_ = estimates > known.limit
                flag = np.where(long_, -1, 1) * (int(long_.sum()) + 1)  # sign: long list
                held.append((tokens, np.full(len(tokens), cid), np.full(len(tokens), len(found)),
                             np.full(len(tokens), k), flag))
                size += len(tokens)
                if size >= PART // 4:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return texts.select("text").mapInArrow(
        run, "bucket long, tokens binary, cids binary, sizes binary, ks binary, longs binary")


def _bucket_pairs(threshold):
    """Over the postings of one bucket: (a, b, matches, need) of the pairs of
    compatible size that share a posting list."""
    def run(frame):
        import numpy as np
        import pandas as pd

        def column(name, kind):
            return np.concatenate([np.frombuffer(x, kind) for x in frame[name]])

        tokens, cids = column("tokens", np.uint64), column("cids", np.int64)
        sizes, ks, longs = column("sizes", np.int64), column("ks", np.int16), column("longs", np.int64)
        order = np.lexsort((cids, tokens))
        tokens, cids = tokens[order], cids[order]
        once = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (cids[1:] != cids[:-1])])
        order, tokens, cids = order[once], tokens[once], cids[once]
        sizes, ks, longs = sizes[order], ks[order], longs[order]
        a, b, need = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        step = 1
        while True:  # lists are at most `limit` long, so this ends there
            same = np.flatnonzero(tokens[step:] == tokens[:-step])
            if not len(same):
                break
            other = same + step
            low, high = (f(sizes[same], sizes[other]) for f in (np.minimum, np.maximum))
            fits = threshold[1] * low >= threshold[0] * high
            x, y = same[fits], other[fits]
            a.append(cids[x])
            b.append(cids[y])
            need.append(np.minimum(ks[x], ks[y]) - np.minimum(longs[x], longs[y]))
            step += 1
        a, b, need = map(np.concatenate, (a, b, need))
        order = np.lexsort((b, a))
        a, b, need = a[order], b[order], need[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) \
            if len(a) else np.empty(0, np.int64)
        return pd.DataFrame({"a": a[first], "b": b[first],
                             "c": np.diff(np.append(first, len(a))), "need": need[first]})

    return run


def _long_rows(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for tokens, cids in zip(batch.column("tokens").to_pylist(), batch.column("cids").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(tokens, np.int64)), pa.array(np.frombuffer(cids, np.int64))],
                ["token", "cid"])


def candidates(posts: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(a, b) of classes that may be linked, or hang together so that those
    that may be linked in long lists do."""
    pairs = (posts.where("bucket >= 0").groupBy("bucket")
             .applyInPandas(_bucket_pairs(threshold), "a long, b long, c long, need long")
             .groupBy("a", "b").agg(F.sum("c").alias("c"), F.first("need").alias("need"))
             .where("c >= need").select("a", "b"))
    long_ = posts.where("bucket < 0").mapInArrow(_long_rows, "token long, cid long").distinct()
    lists = store(long_, "long_lists")
    low = store(lists.groupBy("token").agg(F.min("cid").alias("b"), F.count("*").alias("n"))
                .where("n > 1").select("token", "b"), "long_heads")  # at most OFTEN
    hung = join_sized(lists, low, "token", "inner", OFTEN).select(F.col("cid").alias("a"), "b")
    return pairs.unionByName(hung.where("a <> b").distinct())


class PrefixHints:
    """Prefixes of some sets: match count first, then the shingles."""

    def __init__(self, hints: list):
        import numpy as np

        arrays = [np.frombuffer(x, np.uint64) for x in hints]
        self.ks = np.array([int(x[0]) for x in arrays], np.int64)
        self.index = Postings([x[1:] for x in arrays])

    def near(self, hint: bytes):
        import numpy as np

        own = np.frombuffer(hint, np.uint64)
        return np.flatnonzero(self.index.shared(own[1:]) >= np.minimum(self.ks, int(own[0])))


# ------------------------------------------------------------ the join


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: tuple[int, int] = THRESHOLD, limit: int = LIMIT,
                 often: int = OFTEN, matches: int = MATCHES, largest: int = 300) -> DataFrame:
    """Per row: doc_id, row_key, n_shingles, class_id (of its set), component_id."""
    texts = _texts(docs, id_col, text_col)
    rows = store(set_rows(texts), "sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    known = frequencies(texts, total, limit, often)
    buckets = 1 << max(0, math.ceil(math.log2(max(1, total) / (4 * PART))))
    posts = store(postings(texts, known, threshold, matches, buckets), "postings")
    comps = store(connected_components(candidates(posts, threshold)), "components")
    ident = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "row_key")
    owners = store(rows.where("cid is not null").groupBy("cid").agg(
        F.min(ident).alias("own"), F.first("n_shingles").alias("n")), "classes")
    sizes = comps.groupBy("root").agg(F.count("*").alias("members"))
    wanted = store(comps.join(sizes, "root").join(owners, F.col("cid") == F.col("node")).select(
        F.col("root").alias("comp"), "members", "cid", "n", "own.id", "own.row_key"), "wanted")

    def sets_of(batches):
        import numpy as np
        import pyarrow as pa

        words = WordIds()
        for batch in slices(batches):
            found = [shingle_set(data, words) for data in raw_bytes(batch)]
            hints = []
            for x in found:
                tokens, _, k = prefix(x, known, threshold, matches)
                hints.append(np.append(np.uint64(k), tokens).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("comp", "members", "cid", "n")),
                 pa.array([x.tobytes() for x in found], pa.binary()), pa.array(hints, pa.binary())],
                ["comp", "members", "cid", "n", "shingles", "hint"])

    keyed = texts.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).drop("doc_id")
    members = store(join_sized(keyed, wanted, ["id", "row_key"], "inner", WIDE)
                    .select("comp", "members", "cid", "n", "text")
                    .mapInArrow(sets_of, "comp long, members long, cid long, n long, "
                                         "shingles binary, hint binary")
                    .dropDuplicates(["cid"]), "members")
    roots = confirm(members, PrefixHints, threshold, largest)
    named = owners.join(roots, F.col("cid") == F.col("node"), "left").select(
        "cid", F.coalesce("root", "cid").alias("root"), F.col("own.id").alias("id"))
    least = named.groupBy("root").agg(F.min("id").alias("least"))
    found = store(named.join(least, "root").select(
        "cid", F.nullif("least", F.lit(NO_ID)).alias("least")), "named")
    out = join_sized(rows, found, "cid", "left", WIDE)
    return out.select("doc_id", "row_key", "n_shingles", F.col("cid").alias("class_id"),
                      F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("least"))
                      .alias("component_id"))
