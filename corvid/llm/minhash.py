"""Near-duplicate detection by b-bit MinHash, with exact links.

1. A document's set is its distinct shingles of ``SHINGLE`` words (one shingle
   if it is shorter). ``HASHES`` minima give a signature that keeps the low
   four bits of each, packed into words; hashes of some full minima each are the
   band keys (``shape``: 22 bands of 5 at the default threshold, 28 of 4 at 0.8). Documents with equal sets form one class, of which
   only one goes on.
2. Classes that share a band key are compared by their packed signatures: the
   share of equal nibbles (bit counts), corrected for chance collisions,
   estimates the similarity. Classes estimated within a margin of the
   threshold hang together in a candidate component; each band bucket yields a
   spanning forest, never all pairs. A bucket of more than ``BUCKET`` classes is
   not gathered here: all its members hang on its smallest one, and their
   signatures are compared in step 3.
3. Links are confirmed on full sets (``confirm``): small components in one task
   each, large ones in two rounds of bounded blocks, whatever their shape. In
   both, a pair is counted only if its signatures are estimated within the
   margin. No pair that could join two groups is left out, and links inside a
   group are not enumerated.

A pair at the threshold shares no band with probability (1 - 0.85^5)^22 =
2.5e-6, or (1 - 0.8^4)^28 = 4e-7, and falls below the margin (five standard
deviations) with 3e-7; pairs above it with less. Everything that is reported linked is exact.

Defined results: null, empty and word-less texts have no shingle, are kept and
linked with nothing; a row without an id is kept only if no row of its group
has an id; rows with the same id share a fate by their own texts; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import (NO_ID, WordIds, drop_rows, gram_hashes, join_sized, mix64, raw_bytes,
                               slices, small_batches, store)
from corvid.llm.components import connected_components
from corvid.llm.confirm import MEMBERS, confirm

SHINGLE = 5
HASHES = 112
THRESHOLD = (85, 100)
MISSED = 1e-5  # share of the pairs at the threshold that may share no band
BUCKET = 4_000
WIDE = 1_000_000  # rows of the key tables that may be broadcast


def shape(threshold: tuple[int, int]) -> tuple[int, int, float]:
    """Rows and bands of the band keys (the longest bands that miss ``MISSED``
    at most) and the margin of the estimate: five standard deviations."""
    share = threshold[0] / threshold[1]
    rows = max((r for r in range(1, HASHES + 1)
                if (1 - share ** r) ** (HASHES // r) <= MISSED), default=1)
    differ = (1 - share) * 15 / 16
    return rows, HASHES // rows, 5 * 16 / 15 * math.sqrt(differ * (1 - differ) / HASHES)


def shingle_set(data: bytes | None, known: WordIds, size: int = SHINGLE):
    """Sorted distinct 64-bit shingle hashes."""
    import numpy as np

    words = (data or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(known.of(words), min(size, len(words))))


def minima(shingles, seeds):
    """The smallest hash under each seed, over blocks of bounded memory."""
    import numpy as np

    out = np.full(len(seeds[0]), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 8192):
            block = shingles[None, i:i + 8192]
            out = np.minimum(out, ((block ^ seeds[1][:, None]) * seeds[0][:, None]).min(1))
    return out


def seeds():
    import numpy as np

    rng = np.random.default_rng(2024)
    return (rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, HASHES, np.uint64))


def pack(values):
    """Low four bits of each minimum, 16 to a word."""
    import numpy as np

    low = (mix64(values) & np.uint64(15)).reshape(-1, 16)
    return (low << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64)


def estimate(a, b):
    """Similarity estimated from packed signatures [..., words], corrected for
    equal nibbles by chance."""
    import numpy as np

    x = a ^ b
    x = x | (x >> np.uint64(1))
    x = x | (x >> np.uint64(2))
    differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(-1, dtype=np.int64)
    return 1 - differ / HASHES * (16 / 15)


def band_keys(values, rows: int, bands: int):
    import numpy as np

    parts = values[:rows * bands].reshape(bands, rows)
    key = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for i in range(rows):
        key = mix64(key ^ parts[:, i])
    return key.view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"),
                                      F.xxhash64(text).alias("row_key"), text.alias("text"))


def signatures(texts: DataFrame, per_band: int, n_bands: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, digest, sig, bands) per row."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        known, seed = WordIds(), seeds()
        for batch in slices(batches):
            sizes, digests, sigs, bands = [], [], [], []
            for data in raw_bytes(batch):
                found = shingle_set(data, known)
                sizes.append(len(found))
                if not len(found):
                    digests.append(None)
                    sigs.append(None)
                    bands.append(None)
                    continue
                low = minima(found, seed)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                sigs.append(pack(low).tobytes())
                bands.append(band_keys(low, per_band, n_bands))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "n_shingles", "digest", "sig", "bands"])

    return texts.mapInArrow(run, "doc_id long, row_key long, n_shingles long, digest binary, "
                                 "sig binary, bands array<long>")


def forest(ids, sigs, least: float) -> list[tuple[int, int]]:
    """Edges (other, smallest) of a spanning forest of the pairs estimated at
    ``least`` or more; each member is compared with all not yet reached."""
    import numpy as np

    order = np.argsort(ids)
    ids, sigs, edges = ids[order], sigs[order], []
    rest = np.arange(len(ids))
    while len(rest) > 1:
        root, rest, reached = rest[0], rest[1:], [rest[0]]
        while reached and len(rest):
            near = estimate(sigs[rest], sigs[reached.pop()]) >= least
            reached += rest[near].tolist()
            edges += [(int(ids[x]), int(ids[root])) for x in rest[near]]
            rest = rest[~near]
    return edges


def _bucket_edges(least: float):
    """Over rows (key, cid, sig) sorted by key: the forests of the buckets."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def edges(key, cid, sig):
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            out = []
            sizes = np.diff(cuts)
            two = cuts[:-1][sizes == 2]
            near = estimate(sig[two], sig[two + 1]) >= least
            out += zip(np.maximum(cid[two], cid[two + 1])[near].tolist(),
                       np.minimum(cid[two], cid[two + 1])[near].tolist())
            for a, b in zip(cuts[:-1][sizes > 2], cuts[1:][sizes > 2]):
                out += forest(cid[a:b], sig[a:b], least)
            found = sorted(set(out))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                               pa.array([x[1] for x in found], pa.int64())],
                                              ["a", "b"])

        left = None  # the last bucket of a batch may go on in the next
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            cid = batch.column("cid").to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()),
                                np.uint64).reshape(len(key), -1)
            if left is not None:
                key, cid, sig = (np.concatenate([x, y]) for x, y in zip(left, (key, cid, sig)))
            if not len(key):
                continue
            cut = int(np.flatnonzero(key == key[-1])[0])
            if cut:
                yield edges(key[:cut], cid[:cut], sig[:cut])
            left = key[cut:], cid[cut:], sig[cut:]
        if left is not None:
            yield edges(*left)

    return run


def candidate_edges(classes: DataFrame, least: float, bucket: int = BUCKET) -> DataFrame:
    """(a, b) such that classes which may be linked hang together."""
    keys = classes.select("cid", "sig", F.explode("bands").alias("key"))
    counts = store(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("cid").alias("low"))
                   .where("n > 1"), "buckets")
    met = join_sized(keys, counts, "key", "inner", WIDE)
    small = (met.where(F.col("n") <= bucket).select("key", "cid", "sig")
             .repartition("key").sortWithinPartitions("key")
             .mapInArrow(_bucket_edges(least), "a long, b long"))
    large = met.where((F.col("n") > bucket) & (F.col("cid") != F.col("low"))) \
        .select(F.col("cid").alias("a"), F.col("low").alias("b"))
    return small.unionByName(large)


class SignatureHints:
    """Packed signatures of some classes; near are those estimated at
    ``least`` or more."""

    def __init__(self, least: float, hints: list):
        import numpy as np

        self.least = least
        self.sigs = np.frombuffer(b"".join(hints), np.uint64).reshape(len(hints), -1)

    def near(self, hint: bytes):
        import numpy as np

        return np.flatnonzero(estimate(self.sigs, np.frombuffer(hint, np.uint64)) >= self.least)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    margin: float | None = None, bucket: int = BUCKET,
                    largest: int = MEMBERS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per row: doc_id, row_key, n_shingles, component_id, kept. Texts are linked
    from a similarity of ``threshold`` (a fraction); bands and margin follow it."""
    per_band, n_bands, deviations = shape(threshold)
    margin = deviations if margin is None else margin
    texts = _texts(docs, id_col, text_col)
    rows = store(signatures(texts, per_band, n_bands), "signatures")
    ident = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "row_key")
    classes = store(rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min(ident).alias("own"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    edges = candidate_edges(classes, threshold[0] / threshold[1] - margin, bucket)
    comps = store(connected_components(edges), "components")
    sizes = comps.groupBy("root").agg(F.count("*").alias("members"))
    wanted = store(
        comps.join(sizes, "root").join(classes.select("cid", "own", "n", "sig"), F.col("cid") == F.col("node"))
        .select(F.col("root").alias("comp"), "members", "cid", "n", F.col("sig").alias("hint"),
                "own.id", "own.row_key"), "wanted")

    def sets_of(batches):
        import pyarrow as pa

        known = WordIds()
        for batch in slices(batches):
            found = [shingle_set(data, known).tobytes() for data in raw_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("comp", "members", "cid", "n", "hint")),
                 pa.array(found, pa.binary())], ["comp", "members", "cid", "n", "hint", "shingles"])

    keyed = texts.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).drop("doc_id")
    sets = store(join_sized(keyed, wanted, ["id", "row_key"], "inner", WIDE)
                 .select("comp", "members", "cid", "n", "hint", "text")
                 .mapInArrow(sets_of, "comp long, members long, cid long, n long, hint binary, "
                                      "shingles binary")
                 .dropDuplicates(["cid"]), "sets")
    least = threshold[0] / threshold[1] - margin
    roots = confirm(sets, functools.partial(SignatureHints, least), threshold, largest)
    grouped = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "digest", F.coalesce("root", "cid").alias("root"), F.col("own.id").alias("id"))
    least = grouped.groupBy("root").agg(F.min("id").alias("least"))
    found = grouped.join(least, "root").select("digest", F.nullif("least", F.lit(NO_ID))
                                               .alias("least"))
    out = rows.select("doc_id", "row_key", "n_shingles", "digest").join(found, "digest", "left")
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "row_key", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    found = near_duplicates(docs, id_col, text_col, **options).where(~F.col("kept"))
    return drop_rows(docs, found.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"),
                                        F.col("row_key").alias("__key")), id_col, text_col)
