"""Source divergence audit by sorting pointers to word starts.

1. Every task takes its Arrow text buffers in slices, finds the starts of all
   terms in the bytes themselves, and sorts these pointers by the words they
   point at: a multikey quicksort (three-way partitions on eight bytes at a
   time; small slices and the next eight bytes of equal ones follow). Equal
   runs are terms: their length is the number of occurrences, their distinct
   documents the document frequency, by language and source. No term becomes a
   Python object before its run is counted.
2. The runs of all slices are summed by Spark (language, source, term), partly
   in the map tasks. A language keeps the terms of ``MIN_DOCS`` documents.
3. ``p = 1 + floor(10^9 (count + 1) / (N + V))`` for each kept term of a group;
   the divergence of p from q is ``floor((p - q)^2 / q)``, in integers.
4. Terms: every group's counts against its language, the first ``TOP`` ranks
   (``row_number``, which Spark limits before it shuffles).
5. Pairs of sources: most terms miss in most sources, where p is one value per
   group. So the sum over all kept terms is (a) what is left if no term
   occurred in both, from each group's histogram of counts, plus (b) a
   correction for terms that occur in both, summed in the tasks term by term
   into one value per pair. The rows of a language's pairs are made only once
   per task, never per term.

Defined results: null text, lang and source count as empty texts; empty and
term-less texts make their (lang, source) occur; rows are documents, repeated
ids or not; ties are ranked by the term's or source's UTF-8 bytes; a language
without kept terms has pairs of value 0 and no term rows; an empty table gives
no rows; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import join_sized, raw_bytes, small_batches, store

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000  # fixed value of the contract: p is in units of 10^-9
SLICE = 4 << 20  # bytes of text whose pointers are sorted at once
SMALL = 1 << 15  # pointers of a slice that one sort finishes
PAIRS = 500_000  # pair sums a task holds before it hands them on
COUNTS = "lang string, source string, term string, n long, docs long"


# ------------------------------------------------------------ pointers


def token_bounds(data):
    """(starts, ends) of the terms in a byte array: letters and any byte of a
    non-ASCII character."""
    import numpy as np

    low = data | 0x20
    word = ((low >= 97) & (low <= 122) & (data < 128)) | (data >= 128)
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    return edge[::2], edge[1::2]


def folded(data):
    """A-Z lower-cased, other bytes as they are."""
    import numpy as np

    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def symbols(padded, start, end, depth: int):
    """Bytes ``8 depth ..`` of every term as one big-endian number, zeros
    after its end (no term holds a zero byte)."""
    import numpy as np

    at = start + 8 * depth
    left = np.clip(end - at, 0, 8)
    at = np.minimum(at, len(padded) - 8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[at]
    value = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)
    shift = ((8 - left) * 8).astype(np.uint64)
    high = np.where(left > 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    return value & (high << np.minimum(shift, np.uint64(63)))


def pointer_sort(padded, start, end):
    """(order, first): a permutation that sorts the terms by their bytes and
    the places in it where a new term begins."""
    import numpy as np

    length = end - start
    order = np.arange(len(start))
    new = np.zeros(len(start), bool)
    todo = [(0, len(start), 0)]  # slices of order, equal in their first 8 * depth bytes
    while todo:
        a, b, depth = todo.pop()
        part = order[a:b]
        keys = symbols(padded, start[part], end[part], depth)
        if b - a <= SMALL:
            order[a:b], new[a:b] = _small_slice(padded, start, end, part, keys, depth)
            continue
        sample = np.sort(keys[::max(1, (b - a) // 63)])
        pivot = sample[len(sample) // 2]
        less, more = keys < pivot, keys > pivot
        equal = ~(less | more)
        ended = equal & (length[part] <= 8 * (depth + 1))  # equal for good
        sides = less, ended, equal & ~ended, more
        order[a:b] = np.concatenate([part[x] for x in sides])
        cuts = (a + np.cumsum([0, *[x.sum() for x in sides]])).tolist()
        for i, deeper in ((0, 0), (2, 1), (3, 0)):
            if cuts[i] < cuts[i + 1]:
                todo.append((cuts[i], cuts[i + 1], depth + deeper))
        new[cuts[1]:cuts[2]][:1] = True
    return order, np.flatnonzero(new)


def _small_slice(padded, start, end, part, keys, depth: int):
    """(order, new) of one slice: sorted by one symbol, then all its equal runs
    at once by the next, as long as a run has terms that go on."""
    import numpy as np

    by = np.argsort(keys, kind="stable")
    part, keys = part[by], keys[by]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    while True:
        depth += 1
        run = np.cumsum(new) - 1
        longer = np.bincount(run, end[part] - start[part] > 8 * depth)
        live = np.flatnonzero(((np.bincount(run) > 1) & (longer > 0))[run])
        if not len(live):
            return part, new
        some, run = part[live], run[live]
        keys = symbols(padded, start[some], end[some], depth)
        by = np.lexsort((keys, run))
        part[live], keys = some[by], keys[by]
        new[live[1:]] |= keys[1:] != keys[:-1]


def runs(data, doc, group):
    """Runs of equal (term, group) in one slice: (term bytes, group,
    occurrences, documents). ``data`` holds the texts one after another;
    ``doc`` are their offsets, ``group`` the group of each."""
    import numpy as np

    start, end = token_bounds(data)
    if not len(start):
        return [], np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.concatenate([folded(data), np.zeros(8, np.uint8)])
    owner = np.searchsorted(doc, start, "right") - 1
    order, first = pointer_sort(padded, start, end)
    term = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    # one key for (term, group, document): documents numbered group by group
    place = np.empty(len(doc), np.int64)
    place[np.argsort(group, kind="stable")] = np.arange(len(doc))
    owner = owner[order]
    by = np.argsort(term * len(doc) + place[owner])
    term, owner = term[by], owner[by]
    own = group[owner]
    fresh = np.concatenate([[True], (term[1:] != term[:-1]) | (own[1:] != own[:-1])])
    other = np.concatenate([[True], owner[1:] != owner[:-1]]) | fresh
    at = np.flatnonzero(fresh)
    counts = np.diff(np.append(at, len(term)))
    docs = np.add.reduceat(other.astype(np.int64), at)
    one = order[first[term[at]]]
    raw = padded.tobytes()
    names = [raw[s:e] for s, e in zip(start[one].tolist(), end[one].tolist())]
    return names, own[at], counts, docs


def _pieces(texts: list[bytes]):
    """Texts as slices of about ``SLICE`` bytes: lists of (number, bytes); a
    longer text comes alone, in pieces cut between terms."""
    held, size = [], 0
    for i, text in enumerate(texts):
        if len(text) > SLICE:
            yield [(i, text)]
            continue
        held.append((i, text))
        size += len(text) + 1
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _long_text(text: bytes) -> dict:
    """term -> occurrences of one long text, piece by piece."""
    import numpy as np

    found: dict = {}
    at = 0
    data = np.frombuffer(text, np.uint8)
    while at < len(data):
        stop = min(len(data), at + SLICE)
        while stop < len(data):  # a term that reaches the cut belongs before it
            starts, ends = token_bounds(data[stop:stop + SLICE])
            if not len(starts) or starts[0]:
                break
            stop += int(ends[0])
            if ends[0] < SLICE:
                break
        names, _, counts, _ = runs(data[at:stop], np.zeros(1, np.int64), np.zeros(1, np.int64))
        for name, n in zip(names, counts.tolist()):
            found[name] = found.get(name, 0) + n
        at = stop
    return found


def term_runs(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs): the runs of all slices."""

    def counted(names, groups, texts):
        import numpy as np
        import pyarrow as pa

        groups = np.array(groups, np.int64)
        for piece in _pieces(texts):
            if len(piece) == 1 and len(piece[0][1]) > SLICE:
                found = _long_text(piece[0][1])
                terms, n = list(found), np.array(list(found.values()), np.int64)
                own = np.full(len(terms), groups[piece[0][0]])
                held = np.ones(len(terms), np.int64)
            else:
                data = np.frombuffer(b" ".join(x for _, x in piece), np.uint8)
                sizes = np.array([len(x) + 1 for _, x in piece])
                terms, own, n, held = runs(data, np.cumsum(sizes) - sizes,
                                           groups[[i for i, _ in piece]])
            if not len(terms):
                continue
            langs, sources = (pa.DictionaryArray.from_arrays(
                pa.array(own, pa.int32()), pa.array([x[k] for x in names], pa.string()))
                .cast(pa.string()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [langs, sources, pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(held, pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    def run(batches):
        # texts of several batches to a slice, so that their runs are longer
        known: dict = {}
        groups, texts, size = [], [], 0
        for batch in batches:
            groups += [known.setdefault(x, len(known)) for x in
                       zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())]
            new = raw_bytes(batch)
            texts += new
            size += sum(map(len, new))
            if size >= SLICE:
                yield from counted(list(known), groups, texts)
                known, groups, texts, size = {}, [], [], 0
        if texts:
            yield from counted(list(known), groups, texts)

    return _texts(docs, lang_col, source_col, text_col).mapInArrow(run, COUNTS)


def _texts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    return small_batches(docs).select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


# ------------------------------------------------------------ counts


def kept_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text", least: int = MIN_DOCS) -> DataFrame:
    """Stored (lang, source, term, n, total): occurrences of every kept term in
    each source that has it, and in the language."""
    counts = (term_runs(docs, lang_col, source_col, text_col)
              .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    one = Window.partitionBy("lang", "term")
    return store(counts.withColumn("all_docs", F.sum("docs").over(one))
                 .withColumn("total", F.sum("n").over(one))
                 .where(F.col("all_docs") >= least)
                 .select("lang", "source", "term", "n", "total"), "terms")


def group_sizes(docs: DataFrame, kept: DataFrame, lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """Stored (lang, source, code, size, own, terms, lang_size): every group with
    the number of its occurrences and of its different kept terms, the terms
    kept by the language and their occurrences there."""
    found = _texts(docs, lang_col, source_col, source_col).select("lang", "source").distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("own"))
    # one row per term of the language: the one of its first source
    terms = (kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
             .groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size")))
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("size", "own", "terms", "lang_size")}
    return store(found.join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
                 .select("lang", "source", F.row_number().over(
                     Window.partitionBy("lang").orderBy("source")).alias("code"),
                     *[zero[c].alias(c) for c in zero]), "groups")


def probability(count: str, size: str, terms: str) -> Column:
    """1 + floor(10^9 (count + 1) / (size + terms)), exactly."""
    return F.expr(f"1L + cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0)) "
                  f"div cast({size} + {terms} as decimal(20,0))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")  # at most 10^18


def term_part(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank) of each group's terms."""
    rows = join_sized(kept, groups.select("lang", "source", "size", "terms", "lang_size"),
                      ["lang", "source"], "inner")
    rows = (rows.withColumn("p", probability("n", "size", "terms"))
            .withColumn("q", probability("total", "lang_size", "terms")).where("p > q")
            .select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value")))
    return _ranked(rows).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


# ------------------------------------------------------------ pairs


def exact_p(count, size, terms):
    """``probability`` of integer arrays, by long division in steps of 1,000
    so that nothing exceeds 64 bits."""
    import numpy as np

    a, b = np.asarray(count, np.int64) + 1, np.asarray(size, np.int64) + terms
    out = np.zeros(np.broadcast(a, b).shape, np.int64)
    for _ in range(3):
        a = a * 1000
        out = out * 1000 + a // b
        a = a % b
    return out + 1


def exact_f(p, q):
    return (p - q) * (p - q) // q


class PairSums(dict):
    """(lang, code, code) -> sum, from arrays."""

    def add(self, lang, own, other, value) -> None:
        import numpy as np

        width = int(max(own.max(initial=0), other.max(initial=0))) + 1
        key = own * width + other
        if width * width <= 4 * len(key):
            sums, seen = np.zeros(width * width, np.int64), np.zeros(width * width, bool)
            np.add.at(sums, key, value)
            seen[key] = True
            keys = np.flatnonzero(seen)
            sums = sums[keys]
        else:
            keys, at = np.unique(key, return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, value)
        for a, b, v in zip((keys // width).tolist(), (keys % width).tolist(), sums.tolist()):
            self[lang, a, b] = self.get((lang, a, b), 0) + v

    def batch(self):
        import pyarrow as pa

        names = list(self)
        out = pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in names], pa.string()),
             pa.array([x[1] for x in names], pa.int64()),
             pa.array([x[2] for x in names], pa.int64()),
             pa.array(list(self.values()), pa.int64())], ["lang", "own", "other", "value"])
        self.clear()
        return out


SUMS = "lang string, own long, other long, value long"
CROSS = 1 << 19  # pairs of sources of terms that are held at once


def common_terms(batches):
    """Part (b): over rows (lang, terms, codes, counts, sizes) of one kept term
    each, what pairs of sources that both have it differ from part (a)."""
    import numpy as np
    import pyarrow.compute as pc

    sums = PairSums()
    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            some = batch.filter(pc.equal(batch.column("lang"), lang))
            many = some.column("codes").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            code, count, size = (some.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                                 for c in ("codes", "counts", "sizes"))
            terms = int(some.column("terms")[0].as_py())
            p, z = exact_p(count, size, terms), exact_p(0, size, terms)
            # entry by entry the sources of the same term: (entry, first, sources)
            reach = np.repeat(many, many)
            first = np.repeat(np.cumsum(many) - many, many)
            ends = np.cumsum(reach)
            at = 0
            while at < len(code):
                stop = max(at + 1, int(np.searchsorted(
                    ends, (ends[at - 1] if at else 0) + CROSS, "right")))
                here = reach[at:stop]
                own = np.repeat(np.arange(at, stop), here)
                step = np.arange(len(own)) - np.repeat(np.cumsum(here) - here, here)
                other = np.repeat(first[at:stop], here) + step
                away = own != other
                own, other = own[away], other[away]
                value = (exact_f(p[own], p[other]) - exact_f(p[own], z[other])
                         - exact_f(z[own], p[other]) + exact_f(z[own], z[other]))
                if len(own):
                    sums.add(lang, code[own], code[other], value)
                at = stop
                if len(sums) > PAIRS:
                    yield sums.batch()
    yield sums.batch()


def single_terms(batches):
    """Part (a): over rows (lang, terms, own, size, counts: [(n, terms)], and
    the other groups' others: [(code, size, different terms)]): pairs as if
    no term occurred in both."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for r in batch.to_pylist():
            terms = r["terms"]
            others = [x for x in r["others"] if x["code"] != r["own"]]
            if not others:
                continue
            code, size, different = (np.array([x[k] for x in others], np.int64)
                                     for k in ("code", "size", "own"))
            into, out = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
            if terms:
                z, zs = int(exact_p(0, r["size"], terms)), exact_p(0, size, terms)
                for h in r["counts"] or []:
                    p = int(exact_p(h["n"], r["size"], terms))
                    into += h["terms"] * exact_f(p, zs)
                    out += h["terms"] * exact_f(zs, p)
                mine = sum(h["terms"] for h in r["counts"] or [])
                into += (terms - mine - different) * exact_f(z, zs)
            own = np.full(len(code), r["own"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["lang"]] * (2 * len(code)), pa.string()),
                 pa.array(np.concatenate([own, code])), pa.array(np.concatenate([code, own])),
                 pa.array(np.concatenate([into, out]))], ["lang", "own", "other", "value"])


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) of each group's other sources."""
    coded = join_sized(kept, groups.select("lang", "source", "code", "size", "terms"),
                       ["lang", "source"], "inner")
    common = (coded.groupBy("lang", "term").agg(
        F.first("terms").alias("terms"), F.collect_list(F.struct("code", "n", "size")).alias("x"))
        .where(F.size("x") > 1)
        .select("lang", "terms", F.col("x.code").alias("codes"), F.col("x.n").alias("counts"),
                F.col("x.size").alias("sizes"))
        .mapInArrow(common_terms, SUMS))
    shape = (coded.groupBy("lang", "code", "n").agg(F.count("*").alias("terms"))
             .groupBy("lang", "code").agg(F.collect_list(F.struct("n", "terms")).alias("counts")))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct(
        F.col("code").cast("long").alias("code"), "size", "own")).alias("others"))
    alone = (groups.join(shape, ["lang", "code"], "left").join(others, "lang")
             .select("lang", "terms", F.col("code").cast("long").alias("own"), "size", "counts", "others")
             .mapInArrow(single_terms, SUMS))
    sums = alone.unionByName(common).groupBy("lang", "own", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", F.col("code").cast("long").alias("code"), "source")
    rows = join_sized(sums, names.withColumnRenamed("code", "own"), ["lang", "own"], "inner")
    rows = join_sized(rows, names.select("lang", F.col("code").alias("other"), F.col("source").alias("item")),
                      ["lang", "other"], "inner")
    return _ranked(rows.select("lang", "source", "item", "value"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text", least: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    kept = kept_counts(docs, lang_col, source_col, text_col, least)
    groups = group_sizes(docs, kept, lang_col, source_col)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pair_part(kept, groups).withColumn("part", F.lit("pair")).select(columns)
            .unionByName(term_part(kept, groups, top).withColumn("part", F.lit("term")).select(columns)))
