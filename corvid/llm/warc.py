"""WARC archives: writing pages as records, and reading archives back with
boundary-chain verification.

``write_warc`` writes one ``WARC/1.0`` record per page. Of pages with equal
payloads of at least ``least`` bytes the one with the largest id is a response,
the others are revisits without a block that refer to it.

``read_warc`` splits files at the record magic, wherever it occurs, so tasks
need no state: every place whose header parses is a *candidate* that points to
its successor (its own offset plus header and block length). Magic inside a
payload gives candidates too. Only what the chain from the start of the file
reaches is a record: within a split the chains are contracted to where they
leave it, pointer jumping over the entry points of splits doubles its stride
each round, and the reachable entries are followed inside their splits again.
Payload digests are taken from the bytes between the verified boundaries.

Scale: archives are read in ordinary splits. Only candidates (headers, no
payloads) are shuffled; pointer jumping sees about one row per split and takes
log2(splits per file) rounds. A payload that goes on in the next split is put
together in one task, and no other is.

Defined results: null html is an empty payload; a page without an id is a
record without an id (null when read back) and a revisit if an equal payload
has an id; repeated rows are records each; line breaks in a url become spaces;
an empty table gives no records; a header may have any length. A chain that
meets bytes which are no record ends there, the rest of that file is left out,
or with ``whole`` the read fails: ``round_trip`` loses no page silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.llm.common import join_sized, new_path, slices, small_batches, store

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST = 1000
URN = "urn:page:"


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", least: int = LEAST) -> None:
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]+", " ").alias("url"),
                        payload.alias("payload"))
    rows = (rows.withColumn("size", F.octet_length("payload"))
            .withColumn("digest", F.sha1(F.col("payload").cast("binary"))))
    again = store(rows.where(F.col("size") >= least).groupBy("digest")
                  .agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
                  .where("n > 1").select("digest", "target"), "equal-payloads")
    rows = join_sized(rows, again, "digest", "left")
    revisit = (F.col("target").isNotNull() & (F.col("size") >= least)
               & ~F.col("page_id").eqNullSafe(F.col("target")))
    urn = lambda c: F.concat(F.lit(f"<{URN}"), F.col(c).cast("string"), F.lit(">"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn("page_id")), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Refers-To", F.when(revisit, urn("target"))),
        _line("WARC-Profile", F.when(revisit, F.lit(
            "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Payload-Length", F.col("size").cast("string")),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the bytes between magics, in file order within a
    split; the first chunk of a file is what precedes its first magic."""
    return (small_batches(spark.read.option("lineSep", MAGIC).text(path))
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("size"),
                    F.col("value").cast("binary").alias("value")))


def parse_header(chunk: bytes) -> dict | None:
    """Header fields of a candidate, with the offset of its block; None if
    there is no complete header with a length."""
    end = chunk.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in chunk[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or len(length) > 15 or b"warc-type" not in fields:
        return None

    def urn(name):
        found = fields.get(name, b"")[len(URN) + 1:-1]
        return int(found) if found.removeprefix(b"-").isdigit() else None

    size = fields.get(b"warc-payload-length", b"")
    return {"block_at": end + 4, "length": int(length),
            "type": fields[b"warc-type"].decode("utf-8", "replace"),
            "page_id": urn(b"warc-record-id"), "refers_to": urn(b"warc-refers-to"),
            "url": fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
            "told": fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode(
                "utf-8", "replace"),
            "told_size": int(size) if size.isdigit() and len(size) < 16 else None}


_FIELDS = {"file": "string", "block": "long", "at": "long", "next": "long", "total": "long",
           "size": "long",
           "type": "string", "page_id": "long", "refers_to": "long", "url": "string",
           "told": "string", "told_size": "long", "block_at": "long", "length": "long",
           "sha1": "string"}


def _candidates(batches):
    """Candidates with offsets counted from the first chunk of their split, and
    a row with the ``total`` bytes of each split."""
    import hashlib

    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64()}
    where, offset, first, waiting, whole = None, 0, False, [], 0
    step = len(MAGIC)

    def table(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(k) for r in rows], kinds[v]) for k, v in _FIELDS.items()],
            list(_FIELDS))

    def total():
        return {"file": where[0], "block": where[1], "total": offset, "size": whole}

    for batch in slices(batches):
        rows = []
        for file, block, size, chunk in zip(*(batch.column(c).to_pylist()
                                              for c in ("file", "block", "size", "value"))):
            if (file, block) != where:
                if where:
                    rows += [x for x, _, _ in waiting] + [total()]
                where, offset, waiting, whole = (file, block), 0, [], size
                first = block == 0
            for entry in waiting:  # payloads that hold the magic go on here
                more = (MAGIC.encode() + chunk)[:entry[2]]
                entry[1].update(more)
                entry[2] -= len(more)
                if not entry[2]:
                    entry[0]["sha1"] = entry[1].hexdigest()
            rows += [x for x, _, left in waiting if not left]
            waiting = [x for x in waiting if x[2]]
            found = None if first else parse_header(chunk)
            first = False
            if found:
                body = chunk[found["block_at"]:found["block_at"] + found["length"]]
                found |= {"file": file, "block": block, "at": offset - step,
                          "next": offset + found["block_at"] + found["length"] + len(END)}
                if len(body) == found["length"]:
                    found["sha1"] = hashlib.sha1(body).hexdigest()
                    rows.append(found)
                else:
                    waiting.append([found, hashlib.sha1(body), found["length"] - len(body)])
            offset += len(chunk) + step
        yield table(rows)
    if where:
        yield table([x for x, _, _ in waiting] + [total()])


def _leave(frame):
    """Where the chain from each candidate leaves its split."""
    frame = frame.sort_values("at", kind="stable")
    leave: dict = {}
    for at, after in zip(frame["at"].tolist()[::-1], frame["next"].tolist()[::-1]):
        leave[at] = leave.get(after, after)
    frame["leave"] = frame["at"].map(leave).astype("int64")
    return frame


def _follow(candidates, entries):
    """The candidates of a split that its reachable entries lead to."""
    after = dict(zip(candidates["at"].tolist(), candidates["next"].tolist()))
    good = set()
    for at in entries["at"].tolist():
        while at in after and at not in good:
            good.add(at)
            at = after[at]
    return candidates[candidates["at"].isin(good)]


def _reachable(nodes: DataFrame) -> DataFrame:
    """(file, at) of the entry points that the start of their file reaches, by
    pointer jumping over ``nodes`` (file, at, leave)."""
    entries = store(nodes.select("file", F.col("leave").alias("at")).unionByName(
        nodes.select("file", F.lit(0).cast("long").alias("at"))).distinct(), "entries")
    jump = store(nodes.join(entries, ["file", "at"], "left_semi").select("file", "at", "leave"),
                 "jumps")
    reached = entries.where("at = 0")
    while jump.head(1):
        step = reached.join(jump, ["file", "at"]).select("file", F.col("leave").alias("at"))
        reached = store(reached.unionByName(step).distinct(), "reached")
        far = jump.select("file", F.col("at").alias("from"), F.col("leave").alias("at"))
        jump = store(far.join(jump, ["file", "at"]).select("file", F.col("from").alias("at"),
                                                           "leave"), "jumps")
    return reached


def _pieces(batches):
    """(file, block, at, value) of every chunk, offsets as in _candidates."""
    import pyarrow as pa

    where, offset = None, 0
    for batch in slices(batches):
        ats, column = [], batch.column("value").to_pylist()
        for file, block, chunk in zip(batch.column("file").to_pylist(),
                                      batch.column("block").to_pylist(), column):
            if (file, block) != where:
                where, offset = (file, block), 0
            ats.append(offset)
            offset += len(chunk) + len(MAGIC)
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("block"), pa.array(ats, pa.int64()),
             batch.column("value")], ["file", "block", "at", "value"])


def _digest_of_pieces(frame):
    import hashlib

    import pandas as pd

    frame = frame.sort_values("piece_at")
    start, length = int(frame["start"].iloc[0]), int(frame["length"].iloc[0])
    data = b"".join(x + MAGIC.encode() for x in frame["value"])
    skip = start - int(frame["piece_at"].iloc[0])
    return pd.DataFrame({"file": frame["file"].iloc[:1], "at": frame["at"].iloc[:1], "sha1": [
        hashlib.sha1(data[skip:skip + length]).hexdigest()]})


def _check_ends(good: DataFrame, splits: DataFrame) -> None:
    """Fail if the chain of a file ends before the file does. The totals count
    a magic behind the last chunk, where only a file cut after a magic has one."""
    files = splits.groupBy("file").agg(F.sum("total").alias("total"), F.max("size").alias("size"))
    ends = good.groupBy("file").agg(F.max("next").alias("end"))
    end = F.coalesce("end", F.lit(0))
    cut = files.join(ends, "file", "left").where(
        (end != F.col("total") - len(MAGIC)) | (F.col("total") == F.col("size")))
    found = cut.select("file", end.alias("end"), "size").orderBy("file").head(1)
    if found:
        raise ValueError(f"records of {found[0]['file']} end at byte {found[0]['end']} of "
                         f"{found[0]['size']}")


def read_warc(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Verified records: file, at, type, page_id, refers_to, url, length,
    sha1 (of the block), told and told_size (payload digest and size in the
    header). With ``whole`` a file that is not records to its end is an error."""
    schema = ", ".join(f"`{k}` {v}" for k, v in _FIELDS.items())
    found = store(_chunks(spark, path).mapInArrow(_candidates, schema), "candidates")
    bases = store(found.where("total is not null").select("file", "block", "total", "size").withColumn(
        "base", F.coalesce(F.sum("total").over(  # a row per split of one file
            Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0))), "splits")
    placed = (found.where("total is null").drop("total", "size")
              .join(bases.select("file", "block", "base"), ["file", "block"])
              .withColumn("at", F.col("at") + F.col("base"))
              .withColumn("next", F.col("next") + F.col("base")).drop("base"))
    placed = store(placed, "placed")
    link = "file string, block long, at long, next long"
    links = placed.select("file", "block", "at", "next")
    chains = store(links.groupBy("file", "block").applyInPandas(_leave, link + ", leave long"),
                   "chains")
    reached = _reachable(chains.select("file", "at", "leave"))
    starts = store(links.join(reached, ["file", "at"], "left_semi").select("file", "block", "at"),
                   "starts")
    real = (links.groupBy("file", "block").cogroup(starts.groupBy("file", "block"))
            .applyInPandas(_follow, link).select("file", "at"))
    good = store(placed.join(real, ["file", "at"], "left_semi"), "records")
    if whole:
        _check_ends(good, bases)
    cut = good.where("sha1 is null").select(
        "file", "at", "length", (F.col("at") + len(MAGIC) + F.col("block_at")).alias("start"))
    if cut.head(1):  # at most one record a split goes on beyond it
        cut = store(cut, "cut")
        pieces = (_chunks(spark, path).mapInArrow(
            _pieces, "file string, block long, at long, value binary")
            .join(bases.select("file", "block", "base"), ["file", "block"])
            .select(F.col("file").alias("f"), (F.col("at") + F.col("base")).alias("piece_at"),
                    "value"))
        inside = ((F.col("f") == F.col("file")) & (F.col("piece_at") < F.col("start") + F.col("length"))
                  & (F.col("piece_at") + F.octet_length("value") + len(MAGIC) > F.col("start")))
        whole = (join_sized(pieces, cut, inside, "inner").drop("f")
                 .groupBy("file", "at").applyInPandas(
                     _digest_of_pieces, "file string, at long, sha1 string"))
        good = (good.withColumnRenamed("sha1", "__sha1").join(whole, ["file", "at"], "left")
                .withColumn("sha1", F.coalesce("__sha1", "sha1")).drop("__sha1"))
    return good.select("file", "at", "type", "page_id", "refers_to", "url", "length", "sha1",
                       "told", "told_size")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", least: int = LEAST, path: str | None = None) -> DataFrame:
    """Write ``pages`` and read the archives back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. A revisit has the size and digest
    of the payload it refers to, as its header states them."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_warc(pages, path, id_col, url_col, payload_col, least)
    revisit = F.col("type") == "revisit"
    return read_warc(spark, path, whole=True).select(
        "page_id",
        F.when(revisit, F.col("told_size")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("told")).otherwise(F.col("sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
