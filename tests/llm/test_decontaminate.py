import random
import re

from corvid.llm import decontaminate as D
from tests.llm.helpers import frame, lower_ascii, prose


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def brute(docs, bench):
    windows = []
    for item, text in bench:
        w = words(text)
        if item is None or not w:
            continue
        n = min(13, len(w))
        windows += [(str(item), w[i:i + n]) for i in range(len(w) - n + 1)]
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    items.add(item)
        out.append((doc_id, len(w), len(hit), tuple(sorted(items)),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, bench):
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = D.contamination(frame(spark, docs), b).collect()
    assert all(r["n_items"] == len(r["items"]) for r in got)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
                   for r in got), key=str)


def test_matches_brute_force_with_awkward_rows(spark):
    item = prose(1, 40)
    near = item.split()
    near[20] = "other"
    docs = [(1, prose(2, 50) + " " + item + " " + prose(3, 60)), (2, None), (3, ""),
            (4, "--- !!"), (5, " ".join(near)), (6, item.upper() + "\n" + item), (6, item.upper()),
            (None, item), (7, " ".join(item.split()[3:15])), (8, " ".join(item.split()[3:16])),
            (9, prose(4, 3000) + " " + item), (10, "a b c d short É one"), (11, "é one"),
            (12, "x " * 50), (12, "x " * 50)]
    bench = [(10, item), (9, "short É one"), (8, None), (7, ""), (None, item), (6, "c d"),
             (5, " ".join(item.split()[5:30])), (4, "x " * 20), (4, "x " * 20), (3, "a")]
    assert run(spark, docs, bench) == brute(docs, bench)


def test_random_texts_over_a_tiny_vocabulary(spark):
    rng = random.Random(5)
    bench = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 18)))) for i in range(12)]
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(30)]
    assert run(spark, docs, bench) == brute(docs, bench)


def test_empty_tables(spark):
    assert run(spark, [], [(1, prose(1, 20))]) == []
    docs = [(1, prose(1, 20))]
    assert run(spark, docs, []) == brute(docs, [])


def test_drop_keeps_columns_and_clean_rows(spark):
    item = prose(1, 40)
    docs = frame(spark, [(1, item), (2, prose(7, 30)), (None, None), (1, prose(8, 30))])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = D.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["row"]) for r in left.collect()) == \
        [(0, "row"), (1, "row"), (2, "row")]


def test_blocks_of_the_benchmark_and_shuffled_contexts(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 3)
    monkeypatch.setattr(D, "CONTEXTS", 1)
    item = prose(1, 60)
    docs = [(1, "a b " + item), (2, prose(3, 80))]
    assert run(spark, docs, [(1, item), (2, "a b")]) == brute(docs, [(1, item), (2, "a b")])


def test_no_python_in_the_plan(spark):
    docs, bench = frame(spark, [(1, prose(1, 30))]), spark.createDataFrame(
        [(1, prose(1, 20))], "item_id long, text string")
    plan = D.contamination(docs, bench)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_long_contaminated_text(spark):
    """A text of 200,000 words, all of them out of the benchmark."""
    items = [prose(500 + i, 400, 5000) for i in range(50)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    long_ = " ".join(items * 10)
    docs = frame(spark, [(1, long_), (2, long_ + " " + prose(1, 100, 5000)), (3, prose(2, 5000, 5000))])
    got = {r["doc_id"]: r for r in D.contamination(docs, bench).collect()}
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["n_items"]) == (200_000, 200_000, 50)
    assert (got[2]["n_words"], got[2]["n_hit"], got[2]["n_items"]) == (200_100, 200_000, 50)
    assert got[1]["contaminated"] and not got[3]["contaminated"]


def test_blocks_of_an_input_without_order(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 3)
    item = prose(3, 60)
    rows = [(i, item if i % 3 == 0 else prose(i + 50, 40)) for i in range(30)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = frame(spark, rows).repartition(7, "source").repartition(5)
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"])
                 for r in D.contamination(docs, bench).collect())
    assert got == sorted((i, len(t.split()), 60 if i % 3 == 0 else 0) for i, t in rows)
