"""Session helpers: building a session for local runs, resolving the shared
checkpoint folder that iterative operators write to, and the tables of an
iterative run (``Tables``). No setting of the caller's session is changed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings used by tests and bench on a single machine. On a cluster the
# caller's session is used as given.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files of earlier rounds once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corvid", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one in this process
    (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    Order: a folder already set on the SparkContext, then the
    ``spark.checkpoint.dir`` setting. Only a local-mode session with neither
    gets a fresh temporary folder (tests, bench); a cluster session without
    a shared folder is an error, since a machine-local folder would not
    survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set on the session")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="corvid-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "folder (HDFS/object store) to cut lineage into")


_FOLDER: ContextVar[str | None] = ContextVar("corvid_workspace", default=None)


@contextmanager
def workspace(spark: SparkSession):
    """A folder of its own in the checkpoint folder for all that operators
    write inside the ``with`` block; deleted, with everything in it, at the
    end. Results that read it lazily must be written or collected before."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corvid/{uuid.uuid4().hex}"
    token = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(token)
        remove_path(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the workspace if there is one, else in the checkpoint
    folder; all executors share both."""
    folder = _FOLDER.get() or f"{checkpoint_dir(spark).rstrip('/')}/corvid"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Settings of the session that rounds are planned in. A table's buckets are its
# partitioning, so joins on the bucket column read it in place, and one sorted
# file per bucket is read as sorted. Static plans keep exchanges at the tables'
# partition count.
ROUND_CONF = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


class Tables:
    """Tables of one iterative run, in one shared folder.

    They are hash-partitioned and sorted on a key (bucketed into ``parts``), and
    read by ``self.spark``, a session beside the caller's with settings of its
    own: joins on the key move neither table, and the caller's session plans
    its other queries as ever. The folder alone is enough to go on after the
    driver is lost: a table counts once its write has been committed, and
    the names are registered anew from the files.
    """

    def __init__(self, spark: SparkSession, folder: str, parts: int):
        self.caller, self.folder, self.parts = spark, folder.rstrip("/"), int(parts)
        self.spark = spark.newSession()
        for key, value in {**ROUND_CONF, "spark.sql.shuffle.partitions": str(self.parts)}.items():
            self.spark.conf.set(key, value)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _registered(self, name: str) -> str:
        unique = uuid.uuid5(uuid.NAMESPACE_URL, self.path(name)).hex
        return f"spark_catalog.default.corvid_{unique}"

    def finished(self, name: str) -> bool:
        return path_exists(self.caller, self.path(name) + "/_SUCCESS")

    def write(self, name: str, df: DataFrame, key: str) -> None:
        """``df`` as a table bucketed on ``key``. It should arrive in ``parts``
        hash partitions of ``key``, so that every bucket is one file."""
        self.forget(name)
        (df.write.mode("overwrite").format("parquet").bucketBy(self.parts, key).sortBy(key)
         .option("path", self.path(name)).saveAsTable(self._registered(name)))

    def read(self, name: str, key: str, columns: str) -> DataFrame:
        """The table in ``self.spark``; ``columns`` is its schema as DDL."""
        table = self._registered(name)
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) "
                           f"SORTED BY ({key}) INTO {self.parts} BUCKETS "
                           f"LOCATION '{self.path(name)}'")
        return self.spark.table(table)

    def files(self, name: str, columns: str) -> DataFrame:
        """The table as the caller's session reads it, by its files."""
        return self.caller.read.schema(columns).parquet(self.path(name))

    def forget(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._registered(name)}")

    def drop(self, *names: str) -> None:
        """Remove tables with their files."""
        self.forget(*names)
        for name in names:
            remove_path(self.caller, self.path(name))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: the plan restarts from the
    written files, and a lost executor costs a re-read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
