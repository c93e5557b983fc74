import hashlib

import pytest

from corvid.llm import warc
from corvid.llm.common import new_path

SCHEMA = "page_id long, url string, html string, type string, file string, digest string"
FAKE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\n"
        "Content-Length: 4\r\n\r\nabcd\r\n\r\n")


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).coalesce(1)


def brute(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        top = max(same, default=None) if len(data) >= 1000 else None
        revisit = top is not None and top != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def awkward():
    long = "é" * 600
    return [(1, "http://a/", "short"), (2, "http://a/\r\nX: y", None), (3, None, ""),
            (4, "u", long), (9, "u", long), (9, "u", long), (7, "u", long), (5, "u", "short"),
            (None, "u", long), (None, "u", "b" * 1000), (10, "u", FAKE), (11, "u", FAKE * 40),
            (12, "u", "x" * 999 + FAKE + "WARC/1.0\r\n"), (13, "u", "\r\n\r\nWARC/1.0\r\n" * 30),
            (14, "u", FAKE[:-8] + "9" * 12 + "\r\n\r\n"), (15, "u", "z" * 200_000),
            (16, "u", FAKE.replace("4", "40000")), (17, "u", "y" * 1000), (18, "u", "y" * 1000)]


@pytest.mark.parametrize("split", ["128m", "3k", "700"])
def test_round_trip(spark, split):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    rows = awkward()
    path = new_path(spark, "test")
    try:
        spark.conf.set(key, split)
        got = warc.round_trip(pages(spark, rows), path=path).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_chain_ends_at_garbage(spark):
    path = new_path(spark, "garbage")
    record = FAKE.replace("99", "1")
    spark.createDataFrame([(record + "garbage " + FAKE,)], "value string").coalesce(1) \
        .write.option("lineSep", "\r\n").text(path)
    assert [r["page_id"] for r in warc.read_warc(spark, path).collect()] == [1]


@pytest.mark.parametrize("split", ["128m", "3k"])
def test_long_url(spark, split):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    rows = [(1, "u", "a"), (2, "http://a/" + "x" * 100_000, "b"), (3, "u", "c"), (4, "u", "d")]
    try:
        spark.conf.set(key, split)
        got = warc.round_trip(pages(spark, rows)).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("rest", ["garbage " + FAKE, FAKE[:-9], FAKE[:10], FAKE[:4]])
def test_whole_files_only(spark, tmp_path, rest):
    for name, text in (("good", FAKE * 3), ("cut", FAKE * 2 + rest)):
        (tmp_path / name).write_bytes(text.encode())
    assert warc.read_warc(spark, str(tmp_path / "good"), whole=True).count() == 3
    with pytest.raises(ValueError, match="cut end"):
        warc.read_warc(spark, str(tmp_path), whole=True)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0
