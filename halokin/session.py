"""Session helpers: a tuned local session for tests/bench, and the shared
scratch folder (``spark.checkpoint.dir``) used to cut lineage.

On a cluster the checkpoint folder is configured by the deployment and must be
a shared file system (HDFS, S3, ...). We read it from the session and only set
our own when it is unset (tests, local runs).
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "halokin") -> SparkSession:
    """Local session with AQE on and the UI off (no server is started)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster session has to name one in ``spark.checkpoint.dir``. Only with a
    local master, where driver and executors share one machine, a private
    temporary folder is set when there is none."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="halokin-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "halokin", f"{tag}-{uuid.uuid4().hex[:12]}")


def remove_scratch(spark: SparkSession) -> bool:
    """Delete the scratch tables of this session (through Hadoop's file system, so on any store).

    Results are lazy and may read scratch tables, so a job calls this when its
    output is written; DataFrames made before can't be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint_root(spark), "halokin"))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


_RESUME: ContextVar[str | None] = ContextVar("halokin_resume", default=None)


@contextmanager
def resumable(root: str) -> Iterator[None]:
    """Within this context ``materialize`` keeps its tables under ``root`` (a shared folder), named by what they are
    made of, and reads a table that an earlier run has finished instead of making it again."""
    token = _RESUME.set(root)
    try:
        yield
    finally:
        _RESUME.reset(token)


def fingerprint(df: DataFrame) -> str:
    """A digest of a frame's plan, and of the path, size and time of every file that it reads.

    The plan is the analysed one, with attribute numbers replaced by their order of appearance. The files' state is a sum of hashes
    made by Spark over the folders that hold them."""
    spark = df.sparkSession
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    seen: dict[str, str] = {}
    plan = re.sub(r"#\d+L?", lambda m: seen.setdefault(m[0], f"#{len(seen)}"), plan)
    folders = sorted({os.path.dirname(f) for f in df.inputFiles()})
    state = None
    if folders:
        files = spark.read.format("binaryFile").load(folders).select("path", "length", "modificationTime")
        each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        state = files.agg(F.count("path"), F.sum("length"), F.sum(each)).first()
    return hashlib.sha256(f"{plan}\n{folders}\n{tuple(state) if state else ()}".encode()).hexdigest()


def _finished(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    return bool(mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark))


def tables_of(spark: SparkSession, root: str) -> set[str]:
    """The names of the finished tables under a ``resumable`` folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(os.path.join(root, "*", "_SUCCESS")))
    return {f.getPath().getParent().getName() for f in found or ()}


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the file instead of recomputing
    the whole upstream plan) and gives later stages column pruning and exact
    row counts from Parquet metadata. See ``resumable`` for jobs that are started again.
    """
    spark = df.sparkSession
    root = _RESUME.get()
    path = os.path.join(root, f"{tag}-{fingerprint(df)[:32]}") if root else scratch_path(spark, tag)
    if not root or not _finished(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
