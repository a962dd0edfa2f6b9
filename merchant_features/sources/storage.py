"""Cutting lineage through storage that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Set to true to have a folder without a scheme, or with ``file:``, taken as mounted on every machine without a trial.
MOUNTED = "spark.merchantFeatures.checkpointIsMounted"

#: Called with every frame before it is written, for tests that look at plans.
on_write: Callable[[DataFrame], None] | None = None
_runs: list[str] = []
_tables: dict[str, list[str]] = {}
_reached: set[tuple[str, str]] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; only a local master may fall back to a temporary one, removed at exit.

    The name of a folder without a scheme, or with ``file:``, does not tell whether it is mounted on all machines of a
    cluster. It is tried once per application, and a cluster is refused a folder that its tasks do not reach.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    master = spark.sparkContext.master
    if configured:
        folder = configured.rstrip("/")
        tried = (spark.sparkContext.applicationId, folder)
        if not shared_by_all(folder, master, spark.conf.get(MOUNTED, "false") == "true") and tried not in _reached:
            if not tasks_reach(spark, folder):
                raise RuntimeError(f"{CHECKPOINT_DIR} names a folder of one machine: {configured}")
            _reached.add(tried)
        return folder
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="checkpoint-")
    atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    spark.conf.set(CHECKPOINT_DIR, fallback)
    return fallback


def shared_by_all(folder: str, master: str, mounted: bool = False) -> bool:
    """Whether the names alone tell that executors of this master see one and the same folder."""
    scheme = folder.partition(":")[0] if ":" in folder.split("/")[0] else ""
    return mounted or master.startswith("local") or scheme not in ("", "file")


def tasks_reach(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds under ``folder`` what tasks on all cores write there, several tasks a core.

    Where the machines have folders of their own, Spark commits such a write without the other machines' files and
    says nothing. Machines that join later are not tried.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    path = f"{folder}/trial-{uuid.uuid4().hex}"
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    found = len(spark.read.schema("id bigint").parquet(path).inputFiles())
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return found == tasks


def run_dir(spark: SparkSession) -> str:
    """Where a run's files go that are not tables: the run's folder, removed with it, else the shared folder."""
    return _runs[-1] if _runs else shared_dir(spark)


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables written inside, removed at the end; results must have been written or taken by then."""
    folder = f"{shared_dir(spark)}/tables/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
        for name in _tables.pop(folder, []):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write once and continue from the written table.

    Lost executors cost nothing computed before, later steps read only the
    columns they need, and Spark knows the table's size when it picks joins.
    """
    if on_write is not None:
        on_write(df)
    folder = _runs[-1] if _runs else f"{shared_dir(df.sparkSession)}/tables"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Write once, dealt by ``key`` into sorted buckets, and continue from that table.

    Joins and windows on the key between tables of equally many buckets need no
    further shuffle; this is the only one. All rows of a key are in one bucket:
    meant for tables whose keys have few rows each, as versions of entities do.
    """
    if on_write is not None:
        on_write(df)
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{run_dir(spark)}/{name}"
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    if _runs:
        _tables.setdefault(_runs[-1], []).append(name)
    return spark.table(name)
