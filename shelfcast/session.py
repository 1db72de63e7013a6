"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Model fits are bound by computing, so small tables too keep a partition per core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Added on a cluster: shuffles start wide, and adaptive execution merges what is small.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}


def build_session(app: str = "shelfcast", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wide = CLUSTER_SETTINGS if master and not master.startswith("local") else {}
    for key, value in {**SETTINGS, **wide, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is set up only for a local master, where driver and executors are one
    process; on a cluster a missing setting, or one that names each machine's own disk, is an error.
    Also points the SparkContext there, so
    that iterative ML fits cut their lineage in the same place.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        _refuse_local(context.master, configured)
        if current is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfcast-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def _refuse_local(master: str, folder: str) -> None:
    if folder.startswith("file:") and not master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, a folder of each machine; name one all executors share")


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute when an executor is lost, every later pass sees the same
    rows in the same place, and being Parquet it is read column by column.
    """
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``materialize`` for the length of a block; the files are deleted at its end.

    Nothing that leaves the block may still read them.
    """
    path = new_shared_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder from whatever file system it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Sends the package's source to the Python workers, once per application.

    Executors have no copy of it unless the job was submitted with one. A cluster refuses a second file
    of the same name, so all operators send it from here, and fits in several threads one at a time.
    """
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="shelfcast-source-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
