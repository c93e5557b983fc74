"""Language identification by segmentation-marginalised unigrams.

The pieces are a fixed public vocabulary (``piece_bpe_32k.model`` by default;
it is read, never trained). For each language a unigram model gives every
piece a probability; the probability of a word is the sum over all of its
segmentations into pieces, computed with a forward pass, and a text scores the
sum of its words' log probabilities. The language is the one with the largest
score, and ``score`` its posterior under equal priors.

Learning: words are counted per language over *all* learning rows, then
expectation-maximisation over all segmentations re-estimates the piece
probabilities. Both the counting and the E-step run as Spark jobs. Every
language of the learning rows is learnt, whatever its share: languages are
taken in blocks of ``LANGS`` in order, and only the names and the table piece x
language of one block are on the driver. The sums of the last E-step are kept
as stored tables (piece, lang, n). Scoring is a scan for each block; with
several blocks the best language and the sum of likelihoods of each text are
put together by id and text.

Words are the runs of letters of the lower-cased text, in chunks of at most
``CHUNK`` characters. Defined results: a text that is null or has no letter
is ``und`` with score 0; without any learnt language every text is ``und``;
ties go to the language first in order; a null id counts as neither held out
nor learning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import fold, mix64, slices, store, text_frame

CHUNK = 24
SLICE = 4_000  # chunks whose lattices are built at once, of up to 8 languages
LANGS = 64  # languages that are learnt and scored at once
FLUSH = 400_000
SPACE = "▁"


def vocabulary(path: str | None = None) -> dict[str, int]:
    """piece -> rank, of a sentencepiece model; single characters included."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).lower()
            if piece.replace(SPACE, "").isalpha() or piece == SPACE:
                out.setdefault(piece, len(out))
    return out


_LETTERS = None


def letter_words(text: str) -> list[str]:
    """Lower-cased runs of letters (and of other word characters but digits);
    none if the text has no letter."""
    global _LETTERS
    if _LETTERS is None:
        import re

        _LETTERS = re.compile(r"[^\W\d_]+").findall
    return _LETTERS(text.lower()) if any(map(str.isalpha, text)) else []


def chunks(word: str) -> list[str]:
    word = SPACE + word
    return [word[i:i + CHUNK] for i in range(0, len(word), CHUNK)]


class Pieces:
    """The vocabulary as hashes of code points, to look up the substrings of
    many words at once."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, pieces: dict[str, int]):
        import numpy as np

        self.size, self.longest = len(pieces), min(CHUNK, max(map(len, pieces), default=1))
        inverse = pow(self.BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            self.powers, self.inverses = (
                np.cumprod(np.array([1] + [x] * (1 << 18), np.uint64), dtype=np.uint64)
                for x in (self.BASE, inverse))
        names = list(pieces)
        sums, ends = self._sums(names)
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        hashes = self._hash(sums, ends - lengths, ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.numbers = np.fromiter(pieces.values(), np.int64, len(names))[order]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[hashes & np.uint64((1 << 20) - 1)] = True

    def _sums(self, words: list[str]):
        """Prefix sums over the joined code points, and where each word ends."""
        import numpy as np

        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(flat) >= len(self.powers):
            raise ValueError("too many characters at once")
        with np.errstate(over="ignore"):
            sums = np.zeros(len(flat) + 1, np.uint64)
            np.cumsum(mix64(flat.astype(np.uint64) + np.uint64(1)) * self.powers[:len(flat)],
                      dtype=np.uint64, out=sums[1:])
        return sums, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))

    def _hash(self, sums, start, end):
        import numpy as np

        with np.errstate(over="ignore"):
            return mix64((sums[end] - sums[start]) * self.inverses[start]
                         + (end - start).astype(np.uint64))

    def edges(self, words: list[str]):
        """(word, end in it, length, piece) of every piece inside a word;
        a character that is no piece is an edge to the number ``size``."""
        import numpy as np

        sums, ends = self._sums(words)
        lengths = np.diff(ends, prepend=0)
        word = np.repeat(np.arange(len(words)), lengths)
        begin = ends - lengths
        at = np.arange(len(word))
        left = ends[word] - at
        out = []
        for length in range(1, self.longest + 1):
            if length > 1:
                at = at[left[at] >= length]
            hashes = self._hash(sums, at, at + length)
            maybe = at if length == 1 else at[self.sieve[hashes & np.uint64((1 << 20) - 1)]]
            if length > 1:
                hashes = hashes[self.sieve[hashes & np.uint64((1 << 20) - 1)]]
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = self.hashes[place] == hashes
            piece = np.where(same, self.numbers[place], self.size)
            if length > 1:
                maybe, piece = maybe[same], piece[same]
            w = word[maybe]
            out.append((w, maybe + length - begin[w], np.full(len(w), length), piece))
        return [np.concatenate(x) for x in zip(*out)]


class Lattices:
    """The segmentation lattices of many words: edges sorted into groups of
    one end and one length, in which a word has one edge at most."""

    def __init__(self, pieces: Pieces, words: list[str]):
        import numpy as np

        self.size = pieces.size
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        word, end, length, piece = pieces.edges(words)
        key = end * 64 + length
        order = np.argsort(key, kind="stable")
        self.word, self.piece, key = word[order], piece[order], key[order]
        cuts = np.flatnonzero(np.diff(key, prepend=-1, append=-1))
        self.groups = [(int(key[i]) >> 6, int(key[i]) & 63, slice(i, j))
                       for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def forward(self, p):
        """alpha [position, word, language] for piece probabilities
        ``p`` [size + 1, language]."""
        import numpy as np

        alpha = np.zeros((int(self.lengths.max(initial=0)) + 1, len(self.lengths), p.shape[1]))
        alpha[0] = 1
        for end, length, some in self.groups:
            word = self.word[some]
            alpha[end, word] += alpha[end - length, word] * p[self.piece[some]]
        return alpha

    def totals(self, alpha):
        import numpy as np

        return alpha[self.lengths, np.arange(len(self.lengths))]

    def expected(self, p, weights):
        """Expected piece counts [size + 1, language] with ``weights``
        [word, language] over all segmentations."""
        import numpy as np

        alpha = self.forward(p)
        beta = np.zeros_like(alpha)
        beta[self.lengths, np.arange(len(self.lengths))] = \
            weights / np.maximum(self.totals(alpha), 1e-300)
        flows = np.zeros((len(self.word), p.shape[1]))
        for end, length, some in reversed(self.groups):
            word = self.word[some]
            flow = p[self.piece[some]] * beta[end, word]
            beta[end - length, word] += flow
            flows[some] = flow * alpha[end - length, word]
        return np.stack([np.bincount(self.piece, flows[:, k], self.size + 1)
                         for k in range(p.shape[1])], 1)


def word_counts(frame: DataFrame) -> DataFrame:
    """(lang, word, n) over a frame (lang, text)."""

    def count(batches):
        from collections import Counter, defaultdict

        import pyarrow as pa

        words: dict = defaultdict(Counter)

        def rows():
            found = [(g, w, n) for g, c in words.items() for w, n in c.items()]
            words.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], kind) for i, kind in
                 enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(),
                                  batch.column("text").to_pylist()):
                words[lang].update(letter_words(text or ""))
            if sum(map(len, words.values())) > FLUSH:
                yield rows()
        yield rows()

    return (frame.mapInArrow(count, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def language_blocks(langs: DataFrame, size: int):
    """The languages in order, in lists of at most ``size``."""
    rest = langs
    while found := [r["lang"] for r in rest.orderBy("lang").limit(size).collect()]:
        yield found
        if len(found) < size:
            return
        rest = langs.where(F.col("lang") > found[-1])


def lattice_slice(langs: int) -> int:
    return max(1, SLICE * 8 // max(8, langs))


def first_guess(size: int, langs: int):
    """By rank in the public vocabulary, the same for all languages."""
    import numpy as np

    p = np.repeat(1.0 / (np.arange(size + 1) + 100.0)[:, None], langs, 1)
    p[-1] = 1e-9
    return p / p.sum(0)


def shares(sums: DataFrame, size: int, langs: int):
    """p [size + 1, language] from expected counts (piece, lang, n)."""
    import numpy as np

    found = sums.toPandas()
    q = np.zeros((size + 1, langs))
    q[found["piece"], found["lang"]] = found["n"]
    q += 0.01  # smoothing; also the unknown character's share
    return q / q.sum(0)


def fit_block(counts: DataFrame, langs: list[str], pieces: dict[str, int],
              rounds: int) -> DataFrame | None:
    """Stored sums (piece, number in ``langs``, n) of the last of ``rounds``
    E-steps over ``counts`` (word, by)."""
    import numpy as np

    at, step = {g: i for i, g in enumerate(langs)}, lattice_slice(len(langs))
    p, sums = first_guess(len(pieces), len(langs)), None
    for _ in range(rounds):
        if sums is not None:
            p = shares(sums, len(pieces), len(langs))

        def expect(batches, p=p):
            import pyarrow as pa

            sums, lookup = np.zeros_like(p), Pieces(pieces)
            for batch in batches:
                words, by = batch.column("word").to_pylist(), batch.column("by").to_pylist()
                parts, weights = [], []
                for word, found in zip(words, by):
                    w = np.zeros(len(langs))
                    for x in found:
                        w[at[x["lang"]]] += x["n"]
                    own = chunks(word)
                    parts += own
                    weights += [w] * len(own)
                for i in range(0, len(parts), step):
                    lattice = Lattices(lookup, parts[i:i + step])
                    sums += lattice.expected(p, np.array(weights[i:i + step]))
            rows, cols = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(cols, pa.int32()),
                 pa.array(sums[rows, cols], pa.float64())], ["piece", "lang", "n"])

        sums = store(counts.mapInArrow(expect, "piece int, lang int, n double")
                     .groupBy("piece", "lang").agg(F.sum("n").alias("n")), "piece-sums")
    return sums


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", mod: int = 3, held: int = 1, rounds: int = 2,
                  vocabulary_path: str | None = None, block: int | None = None) -> dict:
    """The languages, and the expected piece counts of each ``block`` of them,
    as stored tables, learnt from all learning rows."""
    block = block or LANGS
    learn = (text_frame(docs, id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
             .where((fold("doc_id", mod) != held) & F.col("lang").isNotNull())
             .select("lang", "text"))
    pieces = vocabulary(vocabulary_path)
    langs = store(learn.select("lang").distinct(), "languages")
    several = langs.count() > block
    counts = word_counts(learn)
    if several:  # sorted, so that a block reads its own languages only
        counts = store(counts.sortWithinPartitions("lang"), "words-by-language")
    sums = []
    for names in language_blocks(langs, block):
        own = counts.where(F.col("lang").between(names[0], names[-1])) if several else counts
        own = own.groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("by"))
        # one row per distinct word, at most len(names) entries each
        sums.append(fit_block(store(own, "words"), names, pieces, rounds))
    return {"langs": langs, "block": block, "sums": sums, "size": len(pieces),
            "pieces": vocabulary_path}


def models(model: dict):
    """{"langs": [...], "p": [piece + 1, lang]} of one block after the other."""
    for names, sums in zip(language_blocks(model["langs"], model["block"]), model["sums"]):
        p = (first_guess(model["size"], len(names)) if sums is None
             else shares(sums, model["size"], len(names)))
        yield {"langs": names, "p": p, "pieces": model["pieces"]}


class WordScores(dict):
    """word -> row of log probabilities per language; unknown words of a batch
    are scored together."""

    LIMIT = 300_000

    def __init__(self, model: dict):
        import numpy as np

        super().__init__()
        self.p, self.pieces = model["p"], Pieces(vocabulary(model.get("pieces")))
        self.rows = np.zeros((1024, len(model["langs"])))
        self.limit = self.LIMIT * 16 // max(16, len(model["langs"]))
        self.step = lattice_slice(len(model["langs"]))

    def learn(self, words: set[str]) -> None:
        import numpy as np

        if len(self) + len(words) > self.limit:
            self.clear()
        new = [w for w in words if w not in self]
        while len(self) + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        owners, parts = [], []
        for k, w in enumerate(new):
            own = chunks(w)
            parts += own
            owners += [k] * len(own)
        sums = np.zeros((len(new), self.rows.shape[1]))
        for i in range(0, len(parts), self.step):
            lattice = Lattices(self.pieces, parts[i:i + self.step])
            logs = np.log(np.maximum(lattice.totals(lattice.forward(self.p)), 1e-300))
            np.add.at(sums, owners[i:i + self.step], logs)
        self.rows[len(self):len(self) + len(new)] = sums
        for w in new:
            self[w] = len(self)


def _scores(model: dict):
    """Per text of a frame with ``doc_id``, ``held_out`` and ``key``: the best
    of the model's languages, its log likelihood ``top``, and the sum ``rest``
    of all likelihoods as multiples of it (0 if no language can be told)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        langs, known = model["langs"], None
        for batch in slices(batches):
            known = known if known is not None else WordScores(model)
            texts = [letter_words(t or "") for t in batch.column("text").to_pylist()]
            found, tops, rests = [], [], []
            for i in range(0, len(texts), 256):
                some = texts[i:i + 256]
                known.learn({w for words in some for w in words})
                for words in some:
                    if not words or not langs:
                        found.append("und")
                        tops.append(0.0)
                        rests.append(0.0)
                        continue
                    at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    total = known.rows[at].sum(0)
                    best = int(total.argmax())
                    found.append(langs[best])
                    tops.append(float(total[best]))
                    rests.append(float(np.exp(np.clip(total - total[best], -700, 0)).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("key"),
                 pa.array(found, pa.string()), pa.array(tops, pa.float64()),
                 pa.array(rests, pa.float64())],
                ["doc_id", "held_out", "key", "lang_pred", "top", "rest"])

    return run


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
             mod: int = 3, held: int = 1) -> DataFrame:
    schema = "doc_id long, held_out boolean, key long, lang_pred string, top double, rest double"
    frame = text_frame(docs, id_col, text_col)
    frame = (frame.withColumn("held_out", F.coalesce(fold("doc_id", mod) == held, F.lit(False)))
             .withColumn("key", F.xxhash64("text")))
    if len(model["sums"]) < 2:
        none = {"langs": [], "p": first_guess(model["size"], 0), "pieces": model["pieces"]}
        found = frame.mapInArrow(_scores(next(models(model), none)), schema)
    else:
        found = reduce(DataFrame.unionByName, [
            store(frame.mapInArrow(_scores(own), schema), "scores").withColumn("block", F.lit(k))
            for k, own in enumerate(models(model))])
        row = ["doc_id", "held_out", "key"]
        found = found.groupBy(*row, "block").agg(
            F.min(F.struct((-F.col("top")).alias("low"), "lang_pred", "rest")).alias("best"),
            F.count("*").alias("n"))
        found = (found.groupBy(*row).agg(F.collect_list("best").alias("by"), F.max("n").alias("n"))
                 .withColumn("best", F.array_min("by"))
                 .withColumn("rest", F.aggregate("by", F.lit(0.0), lambda total, x: total
                             + x["rest"] * F.exp(F.col("best.low") - x["low"])))
                 .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")))  # repeated rows
                 .select(*row, "best.lang_pred", "rest"))
    score = F.when(F.col("rest") > 0, 1 / F.col("rest")).otherwise(0.0)
    return found.select("doc_id", "held_out", "lang_pred", score.alias("score"))
