"""The shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is made, but only for a local master: on a cluster
    a machine-local folder would lose tables together with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = _local_roots.get(context.applicationId)
    if root is None:
        root = tempfile.mkdtemp(prefix="cohortlens-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[context.applicationId] = root
    return root


def input_bytes(*tables: DataFrame) -> int:
    """Size of all files that the tables are read from."""
    total = 0
    for name in {f for df in tables for f in df.inputFiles()}:
        spark = tables[0].sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


# A task's share of a scan or shuffle, compressed, and the input for which a shuffle gets a partition more.
TASK_BYTES = 8 << 20
PARTITION_BYTES = 2 << 20
_SCAN = "spark.sql.files.maxPartitionBytes"
_SHUFFLED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_small_tasks_lock = threading.Lock()
_small_tasks_open: dict[str, list] = {}


def _bytes(setting: str) -> int:
    """A size setting such as ``64MB``, ``16m`` or ``8388608``."""
    text = setting.strip().lower().removesuffix("b")
    power = "kmgtp".find(text[-1:]) + 1 if text[-1:].isalpha() else 0
    return int(text.rstrip("kmgtp")) << (10 * power)


@contextmanager
def small_tasks(spark: SparkSession, size: int):
    """While active, queries over inputs of ``size`` bytes run in tasks that stay small however large the inputs are.

    For steps that make several wide rows of each narrow one before they aggregate: by default the planner makes tasks of 64 MB
    and more of what comes in, which then hold gigabytes. Threads may share it; the settings return when the last one leaves.
    """
    with _small_tasks_lock:
        users = _small_tasks_open.setdefault(spark.sparkContext.applicationId, [0, {}])
        if not users[0]:
            users[1] = {name: spark.conf.get(name, None) for name in (_SCAN, _SHUFFLED, _PARTITIONS)}
            for name in (_SCAN, _SHUFFLED):
                spark.conf.set(name, str(min(_bytes(spark.conf.get(name)), TASK_BYTES)))
            # A multiple of the session's number, which bucketed tables have.
            given = int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.conf.set(_PARTITIONS, str(given * max(1, -(-size // (PARTITION_BYTES * given)))))
        users[0] += 1
    try:
        yield
    finally:
        with _small_tasks_lock:
            users[0] -= 1
            if not users[0]:
                for name, before in users[1].items():
                    if before is None:
                        spark.conf.unset(name)
                    else:
                        spark.conf.set(name, before)


class Workspace:
    """Tables written by one run, each in its own folder below the shared folder.

    A table that several later steps read is written once as Parquet. Compared with a cache this
    survives lost executors and cuts lineage; and since every reader goes through a file scan, it
    prunes columns and gives the join planner true sizes, so a statistics table is broadcast only
    while its files are below ``spark.sql.autoBroadcastJoinThreshold``.

    As a context manager it deletes its tables at the end of the block, by which time everything that reads
    them has to be written or collected. Otherwise they stay until ``drop`` is called.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_folder(spark)}/run-{uuid.uuid4().hex}"
        self._count = 0
        self._tables: list[str] = []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *failure) -> None:
        self.drop()

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:04d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a DataFrame that scans what was written."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, df: DataFrame, name: str, key: str, *, dealt: bool = False) -> DataFrame:
        """As ``write``, in as many buckets of ``key`` as the session has shuffle partitions.

        Joins and aggregates by ``key`` over such tables need no shuffle. Rows that an aggregate or join by
        ``key`` has just ``dealt`` to partitions are written as they lie, others are shuffled once here. The table is registered in
        the session's catalog under a name of its own, for buckets are known to the planner by that alone.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = self.path(name)
        table = f"cohortlens_{uuid.uuid4().hex}"
        rows = df if dealt else df.repartition(buckets, key)
        rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        self._tables.append(table)
        return self.spark.table(table)

    def drop(self) -> None:
        """Delete the run's tables; DataFrames that read them can no longer be used."""
        while self._tables:
            self.spark.sql(f"drop table if exists {self._tables.pop()}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
