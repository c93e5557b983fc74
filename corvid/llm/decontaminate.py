"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides are cut into lower-cased words. Every ``K`` consecutive words give
a hash; of each ``W = WINDOW - K + 1`` consecutive hashes the smallest (the
leftmost of equals) is kept as a fingerprint with its position. Two texts that
share ``WINDOW`` words share all hashes of one such window and therefore a
fingerprint at the same place, so no shared span of that length is missed.
Fingerprints found in the benchmark are extended by comparing the words
themselves, up to the length that a window needs on either side: a hit of
``K + left + right >= WINDOW`` equal words is a shared window, and every
shared window is found from its own fingerprint. Items shorter than
``WINDOW`` words are one window; their whole length is the gram and every
position a fingerprint.

Scale: documents are scanned once and never shuffled; a row per document (and
per hit) goes on. A place takes the words it is compared by along when it leaves
its text, so a long text with many hits costs no more than many short ones. The fingerprints of the benchmark are broadcast in blocks of
at most ``BLOCK`` (one scan of the documents per block), the words around them
only up to ``CONTEXTS`` rows and ``OCTETS`` bytes, and are joined the ordinary way
beyond (AQE splits a hot fingerprint). Items that agree around a fingerprint share one row, so a passage
common to many items does not multiply the hits.

Defined results: null, empty and word-less documents have no words, no hits
and are clean; repeated rows and ids are judged row by row; benchmark rows
without an id or a word are ignored; an empty benchmark leaves all clean.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import LOWER, UPPER, drop_rows, row_key, store

WINDOW, K = 13, 8
BLOCK = 2_000_000
CONTEXTS, OCTETS = 200_000, 32 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POSITION = (1 << 31) - 1  # low bits of a fingerprint


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def _shift(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0)))


def _pairs(a: Column, by: int, f) -> Column:
    """f(a[i], a[i + by]); the last ``by`` entries see a null."""
    return F.zip_with(a, _shift(a, by), f)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _doubled(df: DataFrame, powers: int) -> DataFrame:
    """Columns __h1, __h2, __h4 ...: hashes of so many words from each place."""
    df = df.withColumn("__h1", F.transform("__words", lambda w: F.xxhash64(w)))
    for i in range(powers):
        df = df.withColumn(f"__h{2 << i}", _pairs(F.col(f"__h{1 << i}"), 1 << i,
                                                  lambda a, b: F.xxhash64(a, b)))
    return df


def _gram(k: int) -> Column:
    """Hashes of every ``k`` words, from the powers of two that add up to it."""
    parts, at = [], 0
    for bit in reversed(range(k.bit_length())):
        if k >> bit & 1:
            parts.append((f"__h{1 << bit}", at))
            at += 1 << bit
    out = F.col(parts[0][0])
    for name, by in parts[1:]:
        out = F.zip_with(out, _shift(F.col(name), by), lambda a, b: F.xxhash64(a, b))
    return F.slice(out, 1, F.greatest(F.size("__words") - (k - 1), F.lit(0)))


def _placed(hashes: Column) -> Column:
    return F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~POSITION))
                       .bitwiseOR(i.cast("long")))


def _fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Add __fps: hash and position of the winnowed ``K``-grams, and of every
    gram of a length in ``short``."""
    powers = max(K, *short, 1).bit_length() - 1
    df = _doubled(df, powers).withColumn("__c1", _placed(_gram(K)))
    # minimum over W = 6 places as 2, 4 and 4 + 2
    df = df.withColumn("__c2", _pairs(F.col("__c1"), 1, _least))
    df = df.withColumn("__c4", _pairs(F.col("__c2"), 2, _least))
    df = df.withColumn("__c6", _pairs(F.col("__c4"), 2, _least))
    full = F.array_distinct(F.slice("__c6", 1, F.greatest(
        F.size("__c6") - (WINDOW - K), F.least(F.size("__c6"), F.lit(1)))))
    return df.withColumn("__fps", F.concat(full, *[_placed(_gram(n)) for n in short]))


def _key(c: Column) -> Column:
    return F.shiftright(c, 31)


def _word(at: Column) -> Column:
    return F.get("__words", at)  # null outside the text


def benchmark_contexts(bench: DataFrame, id_col: str = "item_id",
                       text_col: str = "text") -> DataFrame:
    """Stored rows (fp, k, need, gram, before, after, items): a fingerprint, its
    words, the up to 5 words before (nearest first) and after it, how many of
    those must agree, and the items that have it so."""
    items = (bench.select(F.col(id_col).cast("string").alias("__item"),
                          words(F.col(text_col)).alias("__words"))
             .where(F.col("__item").isNotNull() & (F.size("__words") > 0)))
    long_items = _fingerprints(items.where(F.size("__words") >= WINDOW), [])
    # outer: from a plain explode the optimizer infers a filter on the array's
    # size and pushes it below, with the whole chain of hashes written out
    placed = (long_items.select("__item", "__words", F.explode_outer("__fps").alias("__c"))
              .where(F.col("__c").isNotNull())
              .withColumn("__p", F.col("__c").bitwiseAND(F.lit(POSITION)).cast("int")))
    wings = WINDOW - K
    full = placed.select(
        _key(F.col("__c")).alias("fp"), F.lit(K).alias("k"), F.lit(wings).alias("need"),
        F.slice("__words", F.col("__p") + 1, K).alias("gram"),
        F.array(*[_word(F.col("__p") - (j + 1)) for j in range(wings)]).alias("before"),
        F.array(*[_word(F.col("__p") + (K + j)) for j in range(wings)]).alias("after"), "__item")
    # an item of n < WINDOW words is its own gram, with nothing to extend
    small = items.where(F.size("__words") < WINDOW)
    none = F.array(*[F.lit(None).cast("string")] * wings)
    lone = []
    lengths = small.select(F.size("__words").alias("n")).distinct().collect()  # 12 at most
    for n in sorted(r["n"] for r in lengths):
        some = _doubled(small.where(F.size("__words") == n), n.bit_length() - 1)
        lone.append(some.select(
            _key(_placed(_gram(n))[0]).alias("fp"), F.lit(n).alias("k"), F.lit(0).alias("need"),
            F.col("__words").alias("gram"), none.alias("before"), none.alias("after"), "__item"))
    rows = functools.reduce(DataFrame.unionByName, lone, full)
    return store(rows.groupBy("fp", "k", "need", "gram", "before", "after")
                 .agg(F.collect_set("__item").alias("items")), "benchmark")


def _run_length(a: Column, b: Column) -> Column:
    """How many entries of two arrays are equal from the first on."""
    differ = F.zip_with(a, b, lambda x, y: ~F.coalesce(x == y, F.lit(False)))
    at = F.array_position(differ, True).cast("int")
    return F.when(at == 0, F.size(differ)).otherwise(at - 1)


def scan(docs: DataFrame, contexts: DataFrame, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key (__id, __key), doc_id, n_words, spans
    (hit [start, end) word intervals, may overlap), items (ids)."""
    short = sorted(r["k"] for r in contexts.where("need = 0").select("k").distinct().collect())
    keys = contexts.select("fp").distinct()
    blocks = max(1, math.ceil(keys.count() / BLOCK))
    rows, octets = contexts.agg(F.count("*"), F.sum(
        F.octet_length(F.concat_ws(" ", "gram", "before", "after", "items")))).first()
    near = contexts if rows > CONTEXTS or (octets or 0) > OCTETS else F.broadcast(contexts)
    wings, reach = WINDOW - K, max(K, *short, 1) + WINDOW - K
    keyed = docs.select(
        F.monotonically_increasing_id().alias("__rid"), *row_key(id_col, text_col),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__text"))
    if blocks > 1:  # every block's scan must see the same numbers
        keyed = store(keyed, "numbered")
    base = keyed.withColumn("__words", words(F.col("__text"))).drop("__text")
    kept = ["__rid", "__id", "__key", "doc_id"]
    cut = _fingerprints(base, short).withColumn("n_words", F.size("__words").cast("long"))

    def with_words(c: Column) -> Column:
        # the few words around a place, so that no row of a place holds the text
        p = c.bitwiseAND(F.lit(POSITION)).cast("int")
        back = F.reverse(F.slice("__words", F.greatest(p - wings, F.lit(0)) + 1,
                                 F.least(p, F.lit(wings))))
        return F.struct(c.alias("__c"), back.alias("__back"),
                        F.slice("__words", p + 1, reach).alias("__on"))

    found = None
    for block in range(blocks):
        # a null fingerprint stands for the document itself, once
        fps = F.concat(F.array(F.lit(None).cast("long")), F.col("__fps")) if block == 0 \
            else F.when(F.size("__fps") > 0, F.col("__fps")).otherwise(
                F.array(F.lit(0).cast("long")))
        some = keys.where(F.pmod(F.xxhash64("fp"), F.lit(blocks)) == block) \
            .withColumn("__known", F.lit(True))
        rows = (cut.select(*kept, "n_words", F.explode_outer(F.transform(fps, with_words)).alias("__x"))
                .select(*kept, "n_words", "__x.*").withColumn("fp", _key(F.col("__c")))
                .join(F.broadcast(some), "fp", "left")  # at most BLOCK keys
                .where(F.col("__c").isNull() | F.col("__known")))
        rows = rows.select(*kept, "n_words", "fp", "__c",
                           F.col("__c").bitwiseAND(F.lit(POSITION)).cast("int").alias("__p"),
                           "__back", "__on")
        found = rows if found is None else found.unionByName(rows)
    hits = found.join(near, "fp", "left")
    k = F.col("k")
    hits = (hits.withColumn("__same", F.slice("__on", 1, k) == F.col("gram"))
            .withColumn("__l", _run_length(F.col("before"), F.col("__back")))
            .withColumn("__r", _run_length(F.col("after"), F.slice("__on", k + 1, wings))))
    hit = F.col("__same") & (F.col("__l") + F.col("__r") >= F.col("need"))
    span = F.struct((F.col("__p") - F.col("__l")).alias("start"),
                    (F.col("__p") + k + F.col("__r")).alias("end"))
    hits = hits.where(F.col("__c").isNull() | hit)
    first = [F.first(c).alias(c) for c in ("__id", "__key", "doc_id", "n_words")]
    return (hits.groupBy("__rid").agg(
        *first, F.collect_set(F.when(hit, span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items"))))).alias("items"))
        .drop("__rid"))


def covered(spans: Column) -> Column:
    """Number of words in the union of the intervals."""
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        F.array_sort(spans), empty,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["reach"])))
            .cast("long").alias("n"),
            F.greatest(acc["reach"], x["end"]).alias("reach")),
        lambda acc: acc["n"])


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", share: int = 20) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, contaminated (one hit
    word in ``share`` or more), items and spans."""
    contexts = benchmark_contexts(bench, item_col, item_text_col)
    return _judged(scan(docs, contexts, id_col, text_col), share).drop("__id", "__key")


def _judged(found: DataFrame, share: int) -> DataFrame:
    n_hit = F.col("n_hit")
    return (found.withColumn("n_hit", covered(F.col("spans")))
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items", F.array_sort("items"))
            .withColumn("contaminated", (n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", share: int = 20) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    contexts = benchmark_contexts(bench, item_col, item_text_col)
    found = _judged(scan(docs, contexts, id_col, text_col), share).where("contaminated")
    return drop_rows(docs, found.select("__id", "__key"), id_col, text_col)
