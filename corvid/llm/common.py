"""Helpers shared by the text operators.

Conventions of every operator here:

* input is a DataFrame with an id and a text column (names are parameters);
  other columns are ignored unless the operator returns its input rows, and
  may have any name;
* null text is treated as a text without words unless stated otherwise;
* intermediate tables that are read more than once are written as Parquet in
  the folder of ``spark.checkpoint.dir`` (``store``), so a lost executor costs
  a re-read; nothing is kept on executor-local disks or on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared checkpoint folder, or in the workspace that
    the caller opened (``corvid.session.workspace``) and that is removed with
    all tables in it."""
    return scratch_path(spark, label)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, mod: int) -> Column:
    """crc32(id as text) mod ``mod``: the split into learning and held-out rows."""
    return F.crc32(F.col(id_col).cast("string")) % mod


BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
         "spark.sql.execution.arrow.maxBytesPerBatch": (None, "8m")}


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends at most 1,000 rows and about 8 MB to Python at
    once, unless it has settings of its own: 10,000 whole texts, the default,
    take hundreds of MB outside the heap of every executor, and so do 1,000
    long ones."""
    conf = df.sparkSession.conf
    for key, (default, value) in BATCH.items():
        if conf.get(key, None) in (default, "2147483647", "-1"):
            conf.set(key, value)
    return df


def text_frame(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id and the text, under fixed names that cannot clash."""
    docs = small_batches(docs)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"), *more)


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def slices(batches, rows: int = 256):
    """Arrow batches in slices, so that few texts are Python objects at once."""
    for batch in batches:
        for i in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(i, rows)


def raw_bytes(batch, name: str = "text") -> list:
    """A string column of an Arrow batch as UTF-8 ``bytes`` (None for null)."""
    import pyarrow as pa

    column = batch.column(name)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


class WordIds(dict):
    """word (bytes) -> 64-bit hash, remembered; forgets all when too large."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list):
        import numpy as np

        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(x):
    """splitmix64 finaliser on a uint64 array."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def gram_hashes(ids, k: int):
    """64-bit hashes of every ``k`` consecutive entries of ``ids``."""
    import numpy as np

    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n]
    return mix64(out)


def partials(frame: DataFrame, run) -> DataFrame:
    """(part, payload): what ``run(batches)`` yields in each task, as bytes."""
    def whole(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for payload in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()),
                                              pa.array([payload], pa.binary())],
                                             ["part", "payload"])

    return frame.mapInArrow(whole, "part long, payload binary")


def tree(parts: DataFrame, merge, fan: int = 16) -> bytes | None:
    """The payloads of ``parts`` merged into one, ``fan`` parts at a time in
    Spark jobs, each level written; None if there is none."""
    def run(frame):
        import pandas as pd

        frame = frame.sort_values("part")
        return pd.DataFrame({"part": [int(frame["part"].iloc[0]) // fan],
                             "payload": [merge(list(frame["payload"]))]})

    now = store(parts, "part")
    last = now.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while last > 0:
        now = store(now.groupBy(F.floor(F.col("part") / fan).alias("g"))
                    .applyInPandas(run, "part long, payload binary"), "part")
        last //= fan
    return now.first()["payload"]


def join_sized(big: DataFrame, small: DataFrame, on, how: str, rows: int = 1_000_000,
               width: Column | None = None) -> DataFrame:
    """Join a stored ``small`` by broadcast when it is small, and by shuffling
    both sides beyond. Its size is its number of rows, or for rows that hold
    arrays the sum of ``width``, their entries."""
    size = small.agg(F.count("*") if width is None else F.sum(width)).first()[0] or 0
    return big.join(F.broadcast(small) if size <= rows else small, on, how)


NO_ID = (1 << 63) - 1  # stands for a null id in join keys


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Key of a row by its id and text: equal rows share it, rows that only
    share the id do not."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__id"),
            F.xxhash64(F.col(text_col).cast("string")).alias("__key")]


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str,
              rows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose key is in ``gone`` (__id, __key), with
    their own columns whatever their names."""
    keyed = docs.select(*row_key(id_col, text_col),
                        whole_row(docs).alias("__row"))
    gone = store(gone.distinct(), "dropped")
    return join_sized(keyed, gone, ["__id", "__key"], "left_anti", rows).select("__row.*")
