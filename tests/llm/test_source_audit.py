"""The divergence audit against exact counting, and its pointer sort."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from corvid.llm import source_audit
from tests.llm.helpers import lower_ascii


def words(text):
    return [lower_ascii(w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def brute(rows, least=3, top=200):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts = Counter(), Counter()
    for lang, source, text in rows:
        own = words(text)
        docs.update((lang, w) for w in set(own))
        counts.update((lang, source, w) for w in own)
    groups = sorted({r[:2] for r in rows})
    kept = defaultdict(list)
    for (lang, w), n in sorted(docs.items()):
        if n >= least:
            kept[lang].append(w)

    def p(lang, source):
        each = [counts[lang, source, w] if source is not None else
                sum(counts[lang, s, w] for la, s in groups if la == lang) for w in kept[lang]]
        return {w: 1 + 10 ** 9 * (c + 1) // (sum(each) + len(each)) for w, c in zip(kept[lang], each)}

    out = []
    for lang, source in groups:
        own = p(lang, source)
        pair = []
        for la, other in groups:
            if la == lang and other != source:
                q = p(lang, other)
                pair.append((other, sum((own[w] - q[w]) ** 2 // q[w] for w in own)))
        q = p(lang, None)
        term = [(w, (own[w] - q[w]) ** 2 // q[w]) for w in own
                if counts[lang, source, w] > 0 and own[w] > q[w]]
        for part, found, most in (("pair", pair, None), ("term", term, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1)
                    for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def frame(spark, rows):
    full = [(i, *r, 2, "x", 1.0, "p", "t") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, lang string, source string, text string, "
                                       "rank int, item string, value double, part string, "
                                       "term string").repartition(3)


def corpus(n=160, seed=2):
    rng = random.Random(seed)
    pool = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)] + \
        ["ÄRGER", "Ärger", "straße", "日本語", "internationalization", "internationally", "Internation"]
    rows = []
    for _ in range(n):
        size = rng.randrange(0, 40)
        text = rng.choice([" ", ", ", "1", "\n"]).join(rng.choices(pool, k=size))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ß", None, "s4"]), text))
    return rows + [("en", "s1", None), ("xx", "lonely", "only once"), ("yy", "a", ""), ("yy", "b", None),
                   ("en", "empty", "123 ..."), ("en", "s1", rows[0][2]), ("en", "s1", rows[0][2]),
                   ("zz", "a", "one"), ("zz", "a", "one one"), ("zz", "b", "ONE")]


def run(spark, rows, **options):
    got = source_audit.audit(frame(spark, rows), **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in got.collect())


def test_against_exact_counts(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_small_slices_and_ranks(spark, monkeypatch):
    for name, value in (("SLICE", 300), ("SMALL", 4), ("PAIRS", 3), ("CROSS", 4)):
        monkeypatch.setattr(source_audit, name, value)
    rows = corpus(60, 5)
    assert run(spark, rows, top=5) == brute(rows, top=5)


def test_long_text_and_empty(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "SLICE", 5000)
    long_ = " ".join(["alpha", "beta" * 2000, "gamma"] * 400) + " delta"
    rows = [("en", s, t) for s, t in (("a", long_), ("b", long_), ("a", "alpha gamma delta"))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("small", [1, 7, 1 << 15])
def test_pointer_sort(monkeypatch, small):
    monkeypatch.setattr(source_audit, "SMALL", small)
    rng = random.Random(1)
    parts = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefgh" * 3, "abcdefgh" * 3 + "x", "é", "éé", "zz"]
    tokens = [rng.choice(parts) + rng.choice(["", "a", "abcdefgh", "q" * 17]) for _ in range(500)]
    data = np.frombuffer(" ".join(tokens).encode(), np.uint8)
    start, end = source_audit.token_bounds(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    order, first = source_audit.pointer_sort(padded, start, end)
    raw = bytes(data)
    found = [raw[s:e] for s, e in zip(start[order], end[order])]
    assert found == sorted(t.encode() for t in tokens)
    assert [found[i] for i in first] == sorted({t.encode() for t in tokens})


def test_probability_is_exact():
    rng = random.Random(9)
    for _ in range(500):
        v = rng.randrange(1, 10 ** rng.randrange(1, 9))
        n = rng.randrange(0, 10 ** rng.randrange(1, 15))
        c = rng.randrange(0, n + 1)
        assert int(source_audit.exact_p(c, n, v)) == 1 + 10 ** 9 * (c + 1) // (n + v)
