"""Toxicity scores behind noisy-channel deobfuscation.

1. A character trigram model is counted over *all* documents.
2. Words that look disguised (digits or marks among letters, runs of one
   character, letters spaced out) become character lattices: every observed
   character may stand for itself, for the letters it resembles, for nothing
   (a separator) or, in a run, for fewer copies. Viterbi decoding under the
   trigram model picks the restored word.
3. Evidence is the log odds of restored words, of their beginnings and of
   their letters without repetition, learnt from labelled rows; a logistic model over a text's strongest and total
   evidence gives the score.

To keep copies of one document from making its rare words look toxic, a
document supports a feature only if it is the first that has it after some
preceding word.

The trigram counts are task-side arrays summed in Spark (at most 28^3 rows).
The classifier is fitted on at most ``sample`` toxic and ``sample`` clean
labelled rows (parameter); the sample's words are counted and their odds taken
in Spark, and all features with odds of ``min_odds`` or more reach the driver:
each needs ``support`` of the toxic rows, so their number is bounded by the
sample. Scoring is one scan without shuffle. Words of any length are decoded,
long ones in overlapping parts of ``LONG`` characters.

Defined results: a null, empty or word-less text has no evidence and gets the
score of none; without labels of both kinds every score is 0; repeated rows
and null ids are scored each (a null id is neither learnt from nor held out).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import fold, raw_bytes, slices, store, text_frame

SAMPLE = 4_000
SPAN = 12
LONG = 64
HELD = 100_000  # features a task holds before it hands them on
#: what a mark may stand for (fixed values)
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
        "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
        "€": "e", "£": "l", "¡": "i", "×": "x"}
SEPARATORS = set(".-_*~'`·,")
STRIP = ".,;:!?\"'()[]{}<>*_~-`"
A = 28  # boundary, a..z, any other letter


def symbol(ch: str) -> int:
    if "a" <= ch <= "z":
        return ord(ch) - 96
    return 27 if ch.isalpha() else 0


def char_model(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id"):
    """log P(c | a, b) as an array [A, A, A], from the whole corpus."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        of = np.zeros(256, np.int64)
        of[ord("a"):ord("z") + 1] = np.arange(1, 27)
        of[ord("A"):ord("Z") + 1] = np.arange(1, 27)
        of[0xC0:] = 27
        sums = np.zeros(A ** 3, np.int64)
        for batch in slices(batches):
            for data in raw_bytes(batch):
                if data:
                    raw = np.frombuffer(data, np.uint8)
                    c = of[raw[(raw & 0xC0) != 0x80]]
                    c = np.concatenate([[0, 0], c, [0]])
                    sums += np.bincount(c[:-2] * A * A + c[1:-1] * A + c[2:], minlength=A ** 3)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())],
                                         ["gram", "n"])

    found = (text_frame(docs, id_col, text_col).select("text")
             .mapInArrow(count, "gram int, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(A ** 3)
    counts[found["gram"]] = found["n"]
    counts = counts.reshape(A, A, A) + 0.5
    return np.log(counts / counts.sum(2, keepdims=True))


def disguised(word: str) -> bool:
    """Letters mixed with look-alike marks or separators, or a run of three."""
    letters = sum(map(str.isalpha, word))
    if not letters:
        return False
    core = word.strip(STRIP)
    inner = any(c in LEET or c in SEPARATORS for c in core) or any(
        c in LEET and c not in "!(" for c in word)
    run = any(a == b == c for a, b, c in zip(word, word[1:], word[2:]))
    return (inner and 2 * letters >= len(core) - 2) or run


def decode(word: str, logp, keep: float = -1.0, swap: float = -2.0, drop: float = -2.0,
           squeeze: float = -1.0) -> str:
    """Viterbi over the word's character lattice; states are the last two
    emitted symbols. The channel costs are fixed log weights."""
    best = {(0, 0): (0.0, "")}
    i, n = 0, len(word)
    while i < n:
        ch, run = word[i], 1
        while i + run < n and word[i + run] == ch:
            run += 1
        options: list[tuple[float, str]] = []
        letters = [(ch, 0.0)] if ch.isalpha() else []
        letters += [(x, swap) for x in LEET.get(ch, "")]
        for letter, cost in letters:
            options.append((cost + (squeeze if run > 2 else squeeze * 2 * (run > 1)), letter))
            if run > 1:
                options.append((cost + (squeeze if run > 2 else 0.0), letter * 2))
            if 2 < run <= 4:
                options.append((cost, letter * run))
        if ch in SEPARATORS or ch in LEET or not ch.isalnum():
            cost = keep if ch in SEPARATORS else drop if ch not in LEET else \
                8 * drop if ch.isdigit() else 3 * drop
            options.append((cost, ""))
        if not options:
            options.append((4 * drop, ""))
        after: dict = {}
        for (a, b), (score, text) in best.items():
            for cost, out in options:
                x, y, s = a, b, score + cost
                for c in out:
                    z = symbol(c)
                    s += logp[x][y][z]
                    x, y = y, z
                if (x, y) not in after or after[x, y][0] < s:
                    after[x, y] = (s, text + out)
        best = after
        i += run
    return max((s + logp[a][b][0], text) for (a, b), (s, text) in best.items())[1]


def short_runs(word: str) -> str:
    """``word`` with runs of five and more of one character cut to five: how
    long a longer run is makes no difference to ``decode``."""
    if len(word) <= 5:
        return word
    out, run = [], 0
    for c, last in zip(word, "\0" + word):
        run = run + 1 if c == last else 1
        if run <= 5:
            out.append(c)
    return "".join(out)


def parts(word: str) -> list[str]:
    """``word`` in parts of at most ``LONG`` characters, cut behind separators
    where there are any near."""
    out = []
    while len(word) > LONG:
        at = max((i + 1 for i in range(LONG // 2, LONG) if word[i] in SEPARATORS), default=LONG)
        out.append(word[:at])
        word = word[at:]
    return [*out, word]


class Restored(dict):
    """word -> restored word, remembered (forgets all when too large)."""

    LIMIT = 200_000

    def __init__(self, logp):
        super().__init__()
        self.logp = logp.tolist()

    def restore(self, word: str) -> str:
        low = word.lower()
        if not disguised(low):
            return low.strip(STRIP)
        return "".join(decode(x, self.logp) for x in parts(short_runs(low))).strip(STRIP)

    def __missing__(self, word: str) -> str:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self.restore(word)
        return value

    def words(self, text: str) -> list[str]:
        """The restored words of a text; of words longer than ``LONG`` also
        every part of ``SPAN`` characters, as of spaced-out letters."""
        return [x for w in joined_words(text) for x in spans(self[w])]


def spans(word: str) -> list[str]:
    if len(word) <= LONG:
        return [word]
    return [word, *(word[i:i + SPAN] for i in range(len(word) - 2))]


def joined_words(text: str) -> list[str]:
    """White-space words; of three or more single characters in a row
    (spaced-out letters) also the joined word, and where it is longer than
    ``SPAN`` or hides a word behind its first letters every part of ``SPAN``
    characters."""
    words = text.split()
    out, run = list(words), []
    for w in [*words, "  "]:
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) > 2:
            joined = "".join(run)
            out += [joined[i:i + SPAN] for i in range(max(1, len(run) - 2))]
        run = []
    return out


def squeezed(word: str) -> str:
    """``word`` with every run of one character reduced to a single one."""
    return "".join(c for c, last in zip(word, " " + word) if c != last)


def word_features(word: str) -> list[str]:
    if len(word) < 3:
        return []
    return [f"={word}", f"~{squeezed(word)}"] + [f"^{word[:k]}" for k in (4, 5, 6)
                                                 if len(word) >= k]


def _supports(frame: DataFrame, logp, first: bool) -> DataFrame:
    """(feature, n): with ``first`` the documents that are the first (by id) to
    have the feature after some word, else all that have it."""

    def count(batches):
        import pyarrow as pa

        restored, found = Restored(logp), {}

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array([f for f, _, _ in found], pa.string()),
                 pa.array([left for _, left, _ in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], ["feature", "left", "doc_id"])
            found.clear()
            return out

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist()):
                words = restored.words(text or "")
                if not first:
                    found.update(((f, "", doc_id), doc_id) for w in set(words)
                                 for f in word_features(w))
                else:
                    for left, word in zip(["", *words], words):
                        for f in word_features(word):
                            found[f, left, 0] = min(doc_id, found.get((f, left, 0), doc_id))
                if len(found) > HELD:
                    yield rows()
        yield rows()

    rows = frame.select("doc_id", "text").mapInArrow(
        count, "feature string, left string, doc_id long")
    if not first:
        return rows.groupBy("feature").agg(F.count("*").alias("n"))
    least = rows.groupBy("feature", "left").agg(F.min("doc_id").alias("doc_id"))
    return least.groupBy("feature").agg(F.count_distinct("doc_id").alias("n"))


def feature_odds(toxic: DataFrame, clean: DataFrame, counts: dict, support: int,
                 min_odds: float) -> DataFrame:
    """(feature, odds) of the features with ``support`` toxic documents or more
    and log odds of ``min_odds`` or more, from (feature, n) of both sides."""
    def share(n, label):
        return F.log((n + 0.5) / F.lit(counts[label] + 1.0))

    some = toxic.where(F.col("n") >= support).join(
        clean.withColumnRenamed("n", "c"), "feature", "left")
    odds = share(F.col("n"), 1) - share(F.coalesce("c", F.lit(0)), 0)
    return some.select("feature", odds.alias("odds")).where(F.col("odds") >= min_odds)


class Evidence(dict):
    """word -> its strongest feature weight, remembered."""

    def __init__(self, model: dict):
        super().__init__()
        self.restored, self.weights = Restored(model["logp"]), model["weights"]

    def __missing__(self, word: str) -> float:
        if len(self) >= Restored.LIMIT:
            self.clear()
        value = self[word] = max(
            (self.weights.get(f, 0.0) for x in spans(self.restored.restore(word))
             for f in word_features(x)), default=0.0)
        return value

    def of(self, text: str | None) -> tuple[float, float]:
        found = [x for x in map(self.__getitem__, joined_words(text or "")) if x > 0]
        return (max(found, default=0.0), math.log1p(sum(found)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic", mod: int = 3, held: int = 1,
                 sample: int = SAMPLE, min_odds: float = 3.0,
                 support: int | None = None) -> dict:
    """``support``: toxic documents that a feature needs, by default 3 or a
    400th of the toxic rows."""
    import numpy as np

    logp = char_model(docs, text_col, id_col)
    frame = text_frame(docs, id_col, text_col)
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("label"))
             .where((fold("doc_id", mod) != held) & F.col("label").isin(0, 1))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    picked = {y: marks.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
              .limit(sample) for y in (0, 1)}
    # at most 2 * sample ids; of rows that share an id one is learnt from
    rows = store(frame.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
                 .groupBy("doc_id", "label").agg(F.max("text").alias("text")), "sample")
    sides = {y: rows.where(F.col("label") == y) for y in (0, 1)}
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return {"logp": logp, "weights": {}, "line": (0.0, 0.0, -60.0)}
    support = max(3, counts[1] // 400) if support is None else support
    weights = {r["feature"]: r["odds"] for r in feature_odds(
        _supports(sides[1], logp, True), _supports(sides[0], logp, False), counts, support,
        min_odds).collect()}
    model = {"logp": logp, "weights": weights}

    def measure(batches):
        import pyarrow as pa

        evidence = Evidence(model)
        for batch in slices(batches):
            x = [evidence.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([a for a, _ in x], pa.float64()),
                 pa.array([b for _, b in x], pa.float64())], ["label", "top", "total"])

    seen = rows.select("label", "text").mapInArrow(
        measure, "label int, top double, total double").toPandas()
    x = np.column_stack([seen["top"], seen["total"], np.ones(len(seen))])
    return model | {"line": logistic(x, seen["label"].to_numpy(float))}


def logistic(x, y, rounds: int = 50) -> tuple:
    """Weights by Newton steps with a small ridge."""
    import numpy as np

    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-4])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge @ w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
                   mod: int = 3, held: int = 1, threshold: float = 0.7) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        evidence, (a, b, c) = Evidence(model), model["line"]
        for batch in slices(batches):
            scores = []
            for text in batch.column("text").to_pylist():
                top, total = evidence.of(text)
                z = max(-700.0, min(700.0, a * top + b * total + c))
                scores.append(1 / (1 + math.exp(-z)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    frame = text_frame(docs, id_col, text_col)
    frame = frame.withColumn("held_out", F.coalesce(fold("doc_id", mod) == held, F.lit(False)))
    return frame.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
