"""Learned operators: held-out accuracy on the small tables, awkward rows."""

import math
import zlib

import numpy as np
import pytest

from corvid.llm import langid, pu_quality, toxicity
from corvid.llm.common import store, table
from tests.llm.helpers import frame, prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF, "documents").cache(), table(spark, SF, "labels").cache()


def held(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod == rest


def labelled(got, labels, column, fold=True):
    marks = {r["doc_id"]: r[column] for r in labels.collect()}
    return [(r, marks[r["doc_id"]]) for r in got if r["doc_id"] in marks and r["held_out"] == fold]


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "!!! 12 ²½"), (4, "!!! 12 ²½"), (None, "idiot l0ser"),
           (None, None), (5, "idiot " * 3), (6, prose(1, 30_000)), (7, "É" * 300_000), (8, "\x00 a")]


def awkward_scores(got):
    rows = got.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d) for d, _ in AWKWARD)
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] is not None and (r["doc_id"] is not None or not r["held_out"])
    return {r["doc_id"]: r for r in rows}


def test_quality(spark, tables):
    docs, labels = tables
    model = pu_quality.fit_quality(docs, labels)
    got = pu_quality.score_quality(docs, model).collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in got)
    pairs = labelled(got, labels, "quality")
    assert sum(r["predicted"] == y for r, y in pairs) >= 0.95 * len(pairs)
    rows = awkward_scores(pu_quality.score_quality(frame(spark, AWKWARD), model))
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    left = pu_quality.keep_quality(frame(spark, AWKWARD), model)
    assert left.columns == frame(spark, AWKWARD).columns
    assert {r["doc_id"] for r in left.collect()} == \
        {k for k, r in rows.items() if r["predicted"] and k is not None} | \
        ({None} if left.where("doc_id is null").count() else set())


def test_quality_from_positives_alone(spark, tables):
    """No negative label is read, and the prior is not taken from the labels."""
    docs, labels = tables
    both = pu_quality.fit_quality(docs, labels)
    only = pu_quality.fit_quality(docs, labels.where("quality = 1"))
    assert all((both[k] == only[k]).all() for k in both)


@pytest.mark.parametrize("prior", [0.1, 0.4, 0.8])
def test_prior_of_a_mixture(prior):
    rng = np.random.default_rng(int(prior * 10))
    good, bad = (lambda n: rng.normal(0, 1, (n, 5))), (lambda n: rng.normal(2.2, 1, (n, 5)))
    n = int(6000 * prior)
    unlabelled = np.concatenate([good(n), bad(6000 - n)])
    assert abs(pu_quality.estimate_prior(good(3000), unlabelled) - prior) < 0.06


@pytest.mark.parametrize("prior,shift", [(0.3, 0.0), (0.9, 0.0), (0.9, 4.0)])
def test_risk_and_gradient(prior, shift):
    """The step's objective against its definition, its gradient against
    differences; with ``shift`` the bracket is negative."""
    rng = np.random.default_rng(3)
    d, k = 4, 3
    w = {"a": rng.normal(size=(d, k)), "b": rng.normal(size=k), "c": rng.normal(size=k),
         "d": np.array([shift])}
    xp, xu = rng.normal(size=(20, d)) + 1, rng.normal(size=(30, d)) - 1
    if shift:  # the network is sure of the positives and against the others
        w["a"], w["b"], w["c"] = np.ones((d, k)), np.zeros(k), np.full(k, 6.0)
        w["d"] = np.array([0.0])

    def objective(v):
        z = [np.tanh(x @ v["a"] + v["b"]) @ v["c"] + v["d"] for x in (xp, xu)]
        plus, minus = np.log1p(np.exp(-z[0])).mean(), np.log1p(np.exp(z[0])).mean()
        bracket = np.log1p(np.exp(z[1])).mean() - prior * minus
        decay = 0.5e-4 * ((v["a"] ** 2).sum() + (v["c"] ** 2).sum())
        return (prior * plus + bracket if bracket >= 0 else -bracket) + decay, bracket

    value, grad = pu_quality.pu_step(w, xp, xu, prior)
    assert abs(value - objective(w)[0]) < 1e-10
    assert (objective(w)[1] < 0) == bool(shift)
    for name in w:
        for i in np.ndindex(w[name].shape):
            up, down = ({n: x.copy() for n, x in w.items()} for _ in range(2))
            up[name][i] += 1e-6
            down[name][i] -= 1e-6
            slope = (objective(up)[0] - objective(down)[0]) / 2e-6
            assert abs(slope - grad[name][i]) < 1e-6


def test_quality_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = labels.where("1 = 0")
    model = pu_quality.fit_quality(docs, none)
    assert {r["score"] for r in pu_quality.score_quality(docs, model).collect()} == {0.5}
    empty = frame(spark, [])
    assert pu_quality.score_quality(empty, pu_quality.fit_quality(empty, labels)).count() == 0
    only = labels.where("quality = 1")
    scores = pu_quality.score_quality(docs, pu_quality.fit_quality(docs, only)).collect()
    assert len(scores) == docs.count()


def test_labels_of_held_out_rows_are_not_learnt(spark, tables):
    from pyspark.sql import functions as F
    docs, labels = tables
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    wrong = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    a, b = (pu_quality.fit_quality(docs, x) for x in (labels, wrong))
    assert all((a[k] == b[k]).all() for k in a)


def test_toxicity(spark, tables):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == held(r["doc_id"], 3, 1) for r in got)
    pairs = labelled(got, labels, "toxic")
    assert sum(r["predicted"] == y for r, y in pairs) >= 0.93 * len(pairs)
    assert all(y for r, y in pairs if r["predicted"])
    rows = awkward_scores(toxicity.score_toxicity(frame(spark, AWKWARD), model))
    assert rows[5]["score"] > rows[1]["score"] == rows[2]["score"] == rows[3]["score"]
    empty = frame(spark, [])
    assert toxicity.score_toxicity(empty, model).count() == 0
    bare = toxicity.fit_toxicity(docs, labels.where("toxic = 0"))
    assert max(r["score"] for r in toxicity.score_toxicity(docs, bare).collect()) < 1e-9


def test_disguised_words_are_restored(spark, tables):
    logp = toxicity.char_model(tables[0]).tolist()
    for seen, meant in {"l0ser": "loser", "id10t": "idiot", "p4th3tic": "pathetic",
                        "looooser": "loser", "s-c-u-m": "scum", "tr@sh": "trash",
                        "$tupid": "stupid", "i.d.i.o.t": "idiot"}.items():
        assert toxicity.disguised(seen) and toxicity.decode(seen, logp) == meant
    assert not any(map(toxicity.disguised, ["the", "the.", "2024", "555-8810", "", "--"]))
    assert "idiot" in toxicity.joined_words("an i d i o t here")
    assert "idiot" in toxicity.joined_words("a i d i o t")
    assert toxicity.joined_words("a b") == ["a", "b"] and toxicity.joined_words("") == []
    assert set(toxicity.word_features("looser")) & set(toxicity.word_features("loser")) == {"~loser"}


def test_disguised_toxic_words_score_high(spark, tables):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    plain = next(r["text"] for r in docs.orderBy("doc_id").collect()
                 if len(r["text"].split()) > 60 and not any(
                     w in r["text"] for w in ("idiot", "loser", "moron", "scum", "stupid")))
    clean = " ".join(plain.split()[:60])
    rows = [clean] + [f"{clean} {w} {clean}" for w in (
        "l0ser idiot m0ron", "i d i o t l o s e r s c u m", "ST*PID!!! IDIOOOT LOOOSER scum",
        "s-c-u-m m.o.r.o.n id10t")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(
        frame(spark, list(enumerate(rows))), model).collect()}
    assert got[0] < 0.3 and all(got[i] > 0.7 for i in range(1, len(rows))), got


def test_decode_is_the_best_path(spark, tables):
    """Viterbi against all readings of a short lattice."""
    import itertools
    logp = toxicity.char_model(tables[0]).tolist()

    def value(text, cost):
        s, a, b = cost, 0, 0
        for c in [toxicity.symbol(x) for x in text] + [0]:
            s, a, b = s + logp[a][b][c], b, c
        return s

    word = "1d3a5"
    options = [[(x, -2.0) for x in toxicity.LEET[c]] + [("", -16.0)] if c in toxicity.LEET
               else [(c, 0.0)] for c in word]
    best = max(((value("".join(t for t, _ in p), sum(c for _, c in p)), "".join(t for t, _ in p))
                for p in itertools.product(*options)))
    assert toxicity.decode(word, logp) == best[1]


def test_language(spark, tables):
    docs, _ = tables
    model = langid.fit_languages(docs)
    got = langid.identify(docs, model).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    pairs = [(r["lang_pred"], truth[r["doc_id"]]) for r in got if r["held_out"]]
    assert len(got) == docs.count() and all(r["held_out"] == held(r["doc_id"], 3, 1) for r in got)
    assert sum(a == b for a, b in pairs) >= 0.98 * len(pairs)
    rows = awkward_scores(langid.identify(frame(spark, AWKWARD), model))
    assert [rows[k]["lang_pred"] for k in (1, 2, 3, 4)] == ["und"] * 4
    assert all(r["lang_pred"] != "und" for k, r in rows.items() if k and k > 4)
    empty = frame(spark, [])
    none = langid.fit_languages(empty)
    assert langid.identify(empty, none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}


def test_every_language_is_learnt(spark):
    rare = "zyxo vuqa zyxo quva xozy vaqu zyxo"
    rows = [(i, f"the house and the garden {i % 7}", "en") for i in range(8_000)]
    rows += [(10_000 + i, rare, "rare") for i in range(4)]
    docs = frame(spark, rows)
    got = langid.identify(docs, langid.fit_languages(docs)).where("doc_id >= 10000").collect()
    assert len(got) == 4 and {r["lang_pred"] for r in got} == {"rare"}


def test_blocks_of_languages(spark, tables):
    docs, _ = tables
    docs = docs.select("doc_id", "text", "lang").limit(300)
    docs = store(docs.unionByName(docs.limit(5)).unionByName(
        frame(spark, AWKWARD).select("doc_id", "text", "lang")), "docs")

    def run(block):
        got = langid.identify(docs, langid.fit_languages(docs, block=block)).collect()
        return sorted(((r["doc_id"], r["lang_pred"], r["held_out"], r["score"]) for r in got),
                      key=str)

    whole, parts = run(64), run(1)
    assert [x[:3] for x in whole] == [x[:3] for x in parts] and len(whole) == docs.count()
    assert [x[3] for x in whole] == pytest.approx([x[3] for x in parts], abs=1e-6)


def test_forward_sums_all_segmentations():
    import itertools

    import numpy as np
    pieces = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aba", langid.SPACE + "a"])}
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces) + 1, 2))
    words = [langid.SPACE + w for w in ("a", "ab", "abab", "babxa")]

    def brute(word):
        total, counts = np.zeros(2), np.zeros_like(p)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, at = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(word[at:i])
                    at = i
            ids = [pieces.get(x, len(pieces) if len(x) == 1 else None) for x in parts]
            if None not in ids:
                value = p[ids].prod(0)
                total += value
                for i in ids:
                    counts[i] += value
        return total, counts

    lattice = langid.Lattices(langid.Pieces(pieces), words)
    totals = lattice.totals(lattice.forward(p))
    assert np.allclose(totals, [brute(w)[0] for w in words])
    want = sum(brute(w)[1] / brute(w)[0] for w in words)
    assert np.allclose(lattice.expected(p, np.ones((len(words), 2))), want)


def test_long_disguised_words_are_decoded(tables):
    logp = toxicity.char_model(tables[0])
    restored = toxicity.Restored(logp)
    assert restored["1d" + "i" * 98 + "0t"] == restored["1diii0t"] == "idiot"
    phrase = ".".join(["hello", "th3re", "y0u", "1d1ot"] * 6)  # over 100 characters
    assert len(phrase) > 100 and any(x.startswith("idiot") for x in toxicity.spans(restored[phrase]))
    assert toxicity.short_runs("a" * 9 + "b") == "aaaaab"
    assert "".join(toxicity.parts(phrase)) == phrase
    assert max(map(len, toxicity.parts("x" * 1000))) <= toxicity.LONG


def test_no_feature_is_cut(spark):
    """More than 20,000 features with odds: all are kept, the clean ones go."""
    toxic = spark.range(25_000).selectExpr("concat('=t', id) feature", "5 + id % 7 n")
    common = spark.range(30_000).selectExpr("concat('=c', id) feature", "100L n")
    clean = common.unionByName(spark.range(10).selectExpr("concat('=t', id) feature", "90L n"))
    got = toxicity.feature_odds(toxic.unionByName(common), clean, {1: 200, 0: 200}, 5, 1.5)
    odds = {r["feature"]: r["odds"] for r in got.collect()}
    assert set(odds) == {f"=t{i}" for i in range(10, 25_000)}
    assert abs(odds["=t14"] - (math.log(5.5 / 201) - math.log(0.5 / 201))) < 1e-12


def test_rows_that_share_an_id_are_learnt_once(spark, tables):
    docs, labels = tables
    many = docs.unionByName(docs.limit(3).join(spark.range(200).select(), how="cross"))
    ids = [r["doc_id"] for r in docs.limit(3).collect()]
    model = toxicity.fit_toxicity(many, labels)
    assert model["line"] == toxicity.fit_toxicity(docs, labels)["line"] and ids
