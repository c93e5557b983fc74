"""Quality rules by distribution divergence.

``reference_table`` adds up, over all documents with a language, the counts of
character classes and of words per language, and keeps the class histogram and
the ``COMMON`` most frequent words of each language that has ``least`` words
(as many as a document needs to be judged, so that each judged document's own
language has a reference, whatever its share). ``judge`` gives every document its
base counts and the Jensen-Shannon distance (square root of the divergence in
bits, 0..1) of its two histograms to the closest language reference; documents
of at least ``min_words`` words are rejected beyond either limit, shorter ones
only by the base rules (their histograms are too coarse to judge).

Scale: words are counted per task and then per (language, word), the ranking
keeps at most ``COMMON`` words a language in each task before it shuffles. The
references are a stored table, of which blocks of ``LANGS`` languages reach the
driver and the tasks. Judging is a scan without shuffle for each block; with
several blocks the smallest distances are put together by id and text.

Defined results: null and empty texts have no words, fail the base rule and
have null distances; without any reference (no language known, empty table)
distances are null and only the base rules decide; repeated rows are judged
each alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import WordIds, gram_hashes, raw_bytes, slices, store, text_frame
from corvid.llm.textstats import (CLASSES, WHITE, byte_counts, class_matrix, dup_lines,
                                  repeat_cover)

COMMON = 100
MIN_WORDS = 100
LANGS = 500  # references that are looked at together
FLUSH = 400_000
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")


def reference_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", common: int = COMMON,
                    least: int = MIN_WORDS) -> DataFrame:
    """Stored (lang, size, items [kind, item, n]): the words in all, the counts
    of classes and of the ``common`` most frequent words of each language."""

    def count(batches):
        from collections import Counter, defaultdict

        import numpy as np
        import pyarrow as pa

        classes, words, matrix = defaultdict(lambda: 0), defaultdict(Counter), class_matrix()
        sizes: Counter = Counter()

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*found), (pa.string(), pa.string(),
                                                                      pa.binary(), pa.int64()))],
                ["lang", "kind", "item", "n"])

        def taken():
            out = [(g, "word", w, n) for g, c in words.items() for w, n in c.items()]
            for lang, found in classes.items():
                totals = np.asarray(found) @ matrix
                out += [(lang, "class", str(i).encode(), int(n)) for i, n in enumerate(totals)]
                out.append((lang, "size", b"", sizes[lang]))
            for x in (words, classes, sizes):
                x.clear()
            return out

        for batch in slices(batches):
            langs = batch.column("lang").to_pylist()
            joined = defaultdict(list)
            for lang, data in zip(langs, raw_bytes(batch)):
                if data:
                    joined[lang].append(data)
            for lang, texts in joined.items():
                classes[lang] += sum(byte_counts(x) for x in texts)
                for data in texts:
                    found = data.lower().split()
                    words[lang].update(found)
                    sizes[lang] += len(found)
            if sum(map(len, words.values())) + 256 * len(classes) > FLUSH:
                yield rows(taken())
        if classes:
            yield rows(taken())

    known = text_frame(docs, id_col, text_col, F.col(lang_col).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull()).select("lang", "text")
    counts = (known.mapInArrow(count, "lang string, kind string, item binary, n long")
              .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    ranked = counts.withColumn("place", F.row_number().over(
        Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")))
    rows = ranked.where(F.col("place") <= F.when(F.col("kind") == "word", common)
                        .otherwise(len(CLASSES))).where(
        F.col("place") <= max(common, len(CLASSES)))  # the limit that tasks apply
    size = F.when(F.col("kind") == "size", F.col("n"))
    return store(rows.groupBy("lang").agg(
        F.sum(size).alias("size"), F.collect_list(F.struct("kind", "item", "n")).alias("items"))
        .where(F.col("size") >= max(1, least)), "references")


def reference_blocks(table: DataFrame, langs: int | None = None):
    """The references, language -> (class shares, {word: share of all words}),
    in dicts of at most ``langs`` languages."""
    langs, rest = langs or LANGS, table
    while found := rest.orderBy("lang").limit(langs).collect():
        out = {}
        for row in found:
            counts = {bytes(x["item"]): x["n"] for x in row["items"] if x["kind"] == "class"}
            total, shares = sum(counts.values()), [0.0] * len(CLASSES)
            for i, n in counts.items():
                shares[int(i)] = n / max(1, total)
            out[row["lang"]] = (shares, {bytes(x["item"]): x["n"] / row["size"]
                                         for x in row["items"] if x["kind"] == "word"})
        yield out
        if len(found) < langs:
            return
        rest = table.where(F.col("lang") > found[-1]["lang"])


def js_distance(p, q):
    """Jensen-Shannon distances (base 2) of the row ``p`` to the rows of ``q``."""
    import numpy as np

    with np.errstate(divide="ignore", invalid="ignore"):
        m = (p + q) / 2
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(-1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def judge(docs: DataFrame, refs: dict, id_col: str = "doc_id", text_col: str = "text",
          min_words: int = MIN_WORDS, class_limit: float = 0.28, word_limit: float = 0.5,
          key: bool = False) -> DataFrame:
    """The rules by the references ``refs``; with ``key`` also a hash of the text."""
    names = [*OUT, "key"] if key else list(OUT)

    def measure(batches):
        import numpy as np
        import pyarrow as pa

        matrix, ids = class_matrix(), WordIds()
        class_refs = np.array([x[0] for x in refs.values()]).reshape(len(refs), len(CLASSES))
        common = {w: i for i, w in enumerate(sorted({w for _, ws in refs.values() for w in ws}))}
        width = max((len(ws) for _, ws in refs.values()), default=0)
        # a reference's own words, padded with a place that no word counts at
        places = np.full((len(refs), width), len(common) + 1)
        word_refs = np.zeros((len(refs), width + 1))
        for k, (_, ws) in enumerate(refs.values()):
            places[k, :len(ws)] = [common[w] for w in ws]
            word_refs[k, :len(ws)] = list(ws.values())
        word_refs[:, -1] = np.clip(1 - word_refs.sum(1), 0, 1)
        for batch in slices(batches):
            out = {k: [] for k in OUT}
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), raw_bytes(batch)):
                data = data or b""
                words = data.split()
                n = len(words)
                hist = byte_counts(data)
                points = int(hist[:0x80].sum() + hist[0xC0:].sum())
                repeats = int(repeat_cover(gram_hashes(ids.of(words), 3), 3, n).sum())
                failed = n < 50 or 100 * repeats > 50 * n
                class_js = word_js = None
                if n and len(refs):
                    classes = hist @ matrix
                    class_js = float(js_distance(classes / max(1, classes.sum()), class_refs).min())
                    rest = len(common)
                    at = np.fromiter((common.get(w, rest) for w in data.lower().split()),
                                     np.int64, n)
                    p = np.bincount(at, minlength=rest + 2) / n
                    own = np.empty_like(word_refs)
                    own[:, :-1] = p[places]
                    own[:, -1] = np.clip(1 - own[:, :-1].sum(1), 0, 1)
                    word_js = float(js_distance(own, word_refs).min())
                far = class_js is not None and n >= min_words and (
                    class_js > class_limit or word_js > word_limit)
                row = (doc_id, n, points - sum(data.count(c) for c in WHITE),
                       sum(data.count(c) for c in SYMBOLS), dup_lines(data), repeats, failed,
                       not failed and not far, class_js, word_js)
                for k, v in zip(OUT, row):
                    out[k].append(v)
            kinds = {"base_failed": pa.bool_(), "kept": pa.bool_(), "class_js": pa.float64(),
                     "word_js": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[k], kinds.get(k, pa.int64())) for k in OUT]
                + ([batch.column("key")] if key else []), names)

    frame = text_frame(docs, id_col, text_col)
    if key:
        frame = frame.withColumn("key", F.xxhash64("text"))
    return frame.mapInArrow(measure, ", ".join(f"{k} {OUT.get(k, 'long')}" for k in names))


OUT = {"doc_id": "long", "n_words": "long", "word_chars": "long", "n_symbols": "long",
       "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean",
       "kept": "boolean", "class_js": "double", "word_js": "double"}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", min_words: int = MIN_WORDS, class_limit: float = 0.28,
                  word_limit: float = 0.5, langs: int | None = None) -> DataFrame:
    """``judge`` by the references of all languages, ``langs`` at a time."""
    limits = (min_words, class_limit, word_limit)
    table = reference_table(docs, id_col, text_col, lang_col, least=min_words)
    if table.count() <= (langs or LANGS):
        return judge(docs, next(reference_blocks(table, langs), {}), id_col, text_col, *limits)
    # texts are told apart by their hash; the counts of equal ones are the same
    base = [c for c in OUT if c not in ("kept", "class_js", "word_js")]
    found = reduce(DataFrame.unionByName, [
        store(judge(docs, refs, id_col, text_col, *limits, key=True), "judged")
        .withColumn("block", F.lit(k)) for k, refs in enumerate(reference_blocks(table, langs))])
    found = found.groupBy("key", *base).agg(
        F.min("class_js").alias("class_js"), F.min("word_js").alias("word_js"),
        F.count_if(F.col("block") == 0).alias("n"))
    far = (F.col("n_words") >= min_words) & (
        (F.col("class_js") > class_limit) | (F.col("word_js") > word_limit))
    return (found.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")))  # repeated rows
            .select(*OUT))
