"""Divergence rules, license scans, registration and the pipeline."""

import itertools
import random
import math
import re

import pytest

import __spark_entry__ as E
from corvid.llm import divergence, licenses
from corvid.llm.common import table
from tests.llm.helpers import frame, prose, white_words

SF = "/root/testdata/sf0.01"


def base(text):
    w, text = white_words(text), text or ""
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    inside = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if white_words(x)]
    n, repeats = len(w), len(inside)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            repeats, n < 50 or 100 * repeats > 50 * n)


AWKWARD = [(1, None), (2, ""), (3, " \n "), (4, "a b c a b c"), (4, "a b c a b c"), (None, "x\n" * 60),
           (5, prose(1, 60)), (6, prose(2, 20_000)), (7, "# é|日本 <b>\n\n# é|日本 <b>\n#"),
           (8, "one two " * 40), (9, "\x00\x1f\x85\xa0 w")]


def test_base_rules(spark):
    docs = frame(spark, AWKWARD)
    got = divergence.quality_rules(docs).collect()
    want = sorted([(d, *base(t)) for d, t in AWKWARD], key=str)
    assert sorted((tuple(r)[:7] for r in got), key=str) == want
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert divergence.quality_rules(frame(spark, [])).count() == 0
    alone = divergence.judge(docs, {}).collect()
    assert all(r["class_js"] is None and r["kept"] == (not r["base_failed"]) for r in alone)


def test_divergence_keeps_good_and_rejects_junk(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = [r for r in divergence.quality_rules(docs).collect() if r["doc_id"] in marks]
    good = [r for r in got if marks[r["doc_id"]] and not r["base_failed"]]
    junk = [r for r in got if not marks[r["doc_id"]]]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)
    assert sum(r["kept"] for r in junk) <= 0.1 * len(junk)


def test_rare_languages_have_references(spark):
    import random

    def text(seed, words):
        rng = random.Random(seed)
        return " ".join(rng.choice(words) for _ in range(120))

    common = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiou"]
    rare = [f"{a}{b}{a}" for a in "npqrstvwxz" for b in "aeiou"]
    rows = [(i, text(i, common), "en") for i in range(2_100)] + [(9_000, text(1, rare), "rare"),
                                                                 (9_000, text(1, rare), "rare")]
    docs = frame(spark, rows)
    whole = sorted(tuple(r) for r in divergence.quality_rules(docs).collect())
    assert all(r[7] for r in whole if r[0] == 9_000) and len(whole) == len(rows)
    parts = sorted(tuple(r) for r in divergence.quality_rules(docs, langs=1).collect())
    assert [r[:8] for r in parts] == [r[:8] for r in whole]
    assert [x for r in parts for x in r[8:]] == pytest.approx([x for r in whole for x in r[8:]])


def test_distance_is_jensen_shannon():
    import numpy as np
    p, q = np.array([0.5, 0.5, 0.0]), np.array([0.25, 0.25, 0.5])

    def kl(a, b):
        return sum(x * math.log2(x / y) for x, y in zip(a, b) if x)

    m = (p + q) / 2
    assert divergence.js_distance(p, q[None])[0] == pytest.approx(
        math.sqrt((kl(p, m) + kl(q, m)) / 2))
    assert divergence.js_distance(p, p[None])[0] == 0


def best_alignment(template, words):
    """Longest common subsequence over whole texts."""
    row = [0] * (len(words) + 1)
    for t in template:
        last = 0
        for j, w in enumerate(words, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + (t == w))
    return row[-1]


SHORT = {k: v for k, v in licenses.TEMPLATES.items()
         if len(licenses.words_of(v.encode())) < licenses.SHORT}


def test_short_notices_at_the_coverage(spark):
    """Every way to replace a fifth of a short notice's words is found, and so
    are notices with a word put in between."""
    rows, want = [], set()
    for name, text in SHORT.items():
        words = text.split()
        n = len(licenses.words_of(text.encode()))
        if n != len(words):
            words = [w.decode() for w in licenses.words_of(text.encode())]
        for gone in itertools.combinations(range(n), n // 5):
            i = len(rows)
            rows.append((i, "some text " + " ".join("zq" if k in gone else w for k, w in enumerate(words))
                         + " and more of it"))
            want.add((i, name))
    rows += [(9001, "Released under an MIT License."), (9002, "All rights are reserved.")]
    want |= {(9001, "MIT-notice"), (9002, "all-rights-reserved")}
    found = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert want <= found and len(want) > 30


def test_whole_licenses_with_replaced_words(spark):
    rng = random.Random(4)
    rows = []
    for i, name in enumerate(["MIT-whole", "ISC-whole", "Zlib", "Unlicense"] * 10):
        words = licenses.TEMPLATES[name].split()
        for k in rng.sample(range(len(words)), len(words) * 18 // 100):
            words[k] = f"zq{k}"
        rows.append((i, name, " ".join(words)))
    found = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(
        frame(spark, [(i, t) for i, _, t in rows])).collect()}
    assert {(i, name) for i, name, _ in rows} <= found


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"]
    words = mit.split()
    changed = " ".join("CHANGED" if i % 29 == 7 else w for i, w in enumerate(words))
    shorter = " ".join(words[:30] + words[34:])
    rows = [(1, None), (2, ""), (3, prose(1, 200)), (4, prose(2, 50) + "\n" + mit + "\n" + prose(3, 9)),
            (4, mit), (4, mit), (5, changed), (6, shorter), (None, "x Released under the MIT License."),
            (7, "All rights reserved. " * 3), (8, " ".join(words[:20])),
            (9, prose(5, 30_000) + " Licensed under CC BY-NC 4.0.")]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    found = {}
    for r in got:
        found.setdefault((r["doc_id"], r["license"]), []).append(r)
    assert set(found) == {(4, "MIT"), (5, "MIT"), (6, "MIT"), (None, "MIT-notice"),
                          (7, "all-rights-reserved"), (9, "CC-BY-NC-4.0-notice")}
    assert len(found[4, "MIT"]) == 3 and len(found[7, "all-rights-reserved"]) == 3
    template = licenses.words_of(mit.encode())
    for doc_id, text in ((5, changed), (6, shorter)):
        (r,) = found[doc_id, "MIT"]
        assert r["matched"] == best_alignment(template, licenses.words_of(text.encode()))
        assert r["coverage"] == r["matched"] / len(template)
    assert {(r["start"], r["end"]) for r in found[4, "MIT"]} == \
        {(0, len(template)), (50, 50 + len(template))}
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_registered_queries():
    names = set(E.queries())
    assert "pipeline" in names
    assert all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11))


@pytest.mark.parametrize("name", sorted(E.LLM_QUERIES & set(E.oracle_sql())))
def test_queries_match_their_sql(spark, name):
    import duckdb

    from check_oracles import TABLES, compare
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    res = compare(spark, con, name, SF)
    assert res["columns_match"] and res["match"], res


def test_pipeline_stages(spark):
    import corpus_pipeline as C
    from corvid.llm.common import store
    docs = table(spark, SF, "documents")
    marks = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {}
    for name, stage in C.STAGES:
        before, docs = docs, store(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != C.STAGES[-1][0]:
            assert docs.columns == before.columns
    ids = [{r["doc_id"] for r in kept[n].select("doc_id").distinct().collect()}
           for n, _ in C.STAGES]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4]
    assert not any(marks.get(i) == 0 for i in ids[0])
    again = divergence.text_frame(kept["minhash_near_dedup"], "doc_id", "text")
    from corvid.llm import minhash, substring_dedup
    assert minhash.near_duplicates(again).where("not kept").count() == 0
    assert substring_dedup.substring_dedup(kept["substring_dedup"]).where("n_removed > 0").count() \
        <= substring_dedup.substring_dedup(kept["minhash_near_dedup"]).where("n_removed > 0").count()
