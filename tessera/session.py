"""Session, table loading and lineage helpers shared by every module."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    Only test/bench code calls this; library functions accept any session.
    The checkpoint directory is set only when the cluster has not named one.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder and
    is used as is; a machine-local temporary folder is made only when nothing is
    configured, which is the situation of unit tests on ``local[*]``.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
        remove_at_end(spark, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Let Hadoop delete ``path`` when the application ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)


def remove_now(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this application that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per application.

    Tasks import this package by name, so every executor needs it whatever its
    working directory is; ``addPyFile`` distributes one zip of the sources.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-src-"), "tessera.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._tessera_shipped = True


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never localCheckpoint).

    Used by iterative operators so that a lost executor does not force a replay
    of every previous iteration.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


class Tables:
    """Lazy accessor for the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)
