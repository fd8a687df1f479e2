"""Spark session and lineage helpers."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Names of the tables that ``cut_in_buckets`` wrote and the catalog still knows.
_BUCKETED: set[str] = set()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                driver_memory: str = "12g") -> SparkSession:
    """Session for scripts and tests. On a cluster the submitted configuration wins."""
    b = SparkSession.builder.appName("godown")
    if master:
        b = b.master(master).config("spark.driver.memory", driver_memory)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may do without one: then a private scratch folder is made, which is removed at exit. On a
    cluster a machine-local folder would lose rows, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="godown-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, compression: str | None = None, folders: str | None = None, rows_a_file: int = 0) -> DataFrame:
    """Write ``df`` once as a parquet table under the shared checkpoint folder and read it back.

    Survives executor loss (the table is on shared storage, unlike a local checkpoint), computes
    the plan once (``Dataset.checkpoint`` on an unpersisted frame runs it twice), and later reads
    get parquet column pruning and filter pushdown. ``folders`` names a column whose values get a folder each; ``rows_a_file``
    bounds the rows of a file (0: no bound).
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/godown-{uuid.uuid4().hex}"
    df.write.mode("error").option("maxRecordsPerFile", rows_a_file).parquet(path, partitionBy=folders, compression=compression)
    return spark.read.parquet(path)


def cut_in_buckets(df: DataFrame, key: str, compression: str | None = None) -> DataFrame:
    """``cut_lineage`` as a table bucketed by ``key``, one bucket a shuffle partition: joins and sums of such tables by that key
    need no further exchange. The rows should come dealt by the key, else every task writes a file a bucket.

    The table is external, under the checkpoint folder, and known to the session's catalog until ``forget_buckets``.
    """
    spark = df.sparkSession
    name = f"godown_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name.replace('_', '-')}"
    writer = df.write.mode("error").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path)
    (writer.option("compression", compression) if compression else writer).saveAsTable(name, format="parquet")
    _BUCKETED.add(name)
    return spark.table(name)


def forget_buckets(df: DataFrame) -> None:
    """Take the table that ``cut_in_buckets`` gave as ``df`` out of the catalog; its files stay."""
    folders = {f.rpartition("/")[0].rpartition("/")[2].replace("-", "_") for f in df.inputFiles()}
    for name in folders & _BUCKETED:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        _BUCKETED.discard(name)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark remove, in the background, the shuffle files of plans that nothing refers to any more. It does so when the driver
    collects its garbage, which a driver that holds little may not do before the disks are full."""
    gc.collect()
    spark._jvm.System.gc()


def drop_written(df: DataFrame) -> None:
    """Remove a table that ``cut_lineage`` wrote, once nothing that is still to run reads it."""
    spark = df.sparkSession
    own = checkpoint_dir(spark).rstrip("/")
    for folder in {re.sub(r"(/godown-[0-9a-f]{32})/[^/]+=[^/]*$", r"\1", f.rpartition("/")[0]) for f in df.inputFiles()}:
        if re.search(r"/godown-[0-9a-f]{32}$", folder) and folder.split(":", 1)[-1].lstrip("/").startswith(own.split(":", 1)[-1].lstrip("/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
