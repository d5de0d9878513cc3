"""Batched, resumable CSV -> Parquet ingest on Structured Streaming, with a manifest.

The original ingest converts a very large set of per-cell CSV files in batches
of N files, one output directory per batch, and reports which batch failed:

* the stream is the list of files (a ``binaryFile`` source of which only the path is
  read); ``maxFilesPerTrigger = N`` makes each micro-batch take N new ones;
* ``trigger(availableNow=True)`` processes everything present, then stops;
* the checkpoint records which files were taken, so a restarted job (or one
  whose executors were lost) resumes where it stopped instead of starting over;
* ``foreachBatch`` reads its files as the one-shot ingest does, each by its own
  header, and writes them to a folder of their own.

The manifest (``_manifest`` beside the data) makes a batch all or nothing. A write first *claims* a
folder ``batch=<id>-<unique>`` that no other write has; when all folders of a batch are written, one file
*commits* them, with the files that each holds. ``read_batches`` reads committed folders only, so what a lost driver
left behind is never read; a batch that is run again leaves out files that are committed already
and writes the others to new folders. ``remove_orphans`` deletes claimed folders without a commit.

No file is lost. A batch that fails is split in halves until the bad files are
alone; the others are written, and the bad ones stand in the manifest as
failed, with their error. ``retry_failed`` takes up all files that failed and were never
committed; every later run does so first. One job at a time writes to an output folder.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Optional, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import scratch_path
from ..sources.ingest import SPECIES_LAYOUT, empty_particles, read_particle_csv, scan_recursive

STATUS_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("rejected", T.LongType(), True),
    T.StructField("claim", T.StringType(), True),
    T.StructField("files", T.ArrayType(T.StringType()), False),
    T.StructField("error", T.StringType(), True),
    T.StructField("at", T.TimestampType(), False),
])
CLAIM_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("claim", T.StringType())])
_FILE_LIST = "path string, modificationTime timestamp, length long, content binary"
#: Folders whose names are broadcast to the scan; more are joined by a shuffle.
BROADCAST_CLAIMS = 500_000

Hook = Callable[[int], None]


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "timestamp": pa.timestamp("us", "UTC")}


def _local(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of the manifest as a frame. From Arrow they are part of the plan: no task runs Python for them."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return spark.createDataFrame(pa.table({f.name: pa.array(c, _ARROW[f.dataType.simpleString()]) for f, c in zip(schema, columns)}), schema)


def _append(spark: SparkSession, out_root: str, table: str, rows: list[tuple], schema: T.StructType) -> None:
    """One more file of a manifest table: it is there as a whole or not at all."""
    df = _local(spark, rows, schema).coalesce(1)
    df = df.withColumn("at", F.current_timestamp()) if table == "commits" else df
    df.write.mode("append").parquet(os.path.join(out_root, "_manifest", table))


def _table(spark: SparkSession, out_root: str, table: str, schema: T.StructType) -> DataFrame:
    # all files are in one folder (of older jobs: in one folder each), so that listing them takes one call
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(os.path.join(out_root, "_manifest", table))
    except AnalysisException:
        return _local(spark, [], schema)


def batch_status(spark: SparkSession, out_root: str) -> DataFrame:
    """The commits of all runs so far: folders that hold files, and files that failed."""
    return _table(spark, out_root, "commits", STATUS_SCHEMA)


def committed_files(spark: SparkSession, out_root: str) -> DataFrame:
    return batch_status(spark, out_root).where("status = 'ok'").select(F.explode("files").alias("file"))


def failed_files(spark: SparkSession, out_root: str) -> DataFrame:
    """(file, batch_id) of the files that failed and are not committed."""
    each = batch_status(spark, out_root).select("batch_id", (F.col("status") == "ok").alias("ok"), F.explode("files").alias("file"))
    return each.groupBy("file").agg(F.max("batch_id").alias("batch_id"), F.bool_or("ok").alias("ok")).where("NOT ok").drop("ok")


def read_batches(spark: SparkSession, out_root: str, species: str = "dm") -> DataFrame:
    """The particles of all committed batches; an empty table if there are none yet.

    One scan of the output folder, joined to the committed folders' names: a partition column, so
    that other folders are pruned when the scan starts."""
    committed = batch_status(spark, out_root).where("status = 'ok'").select(F.col("claim").alias("batch"))
    n = committed.count()
    if not n:
        return empty_particles(spark, species)
    schema = T.StructType([*SPECIES_LAYOUT[species][1], T.StructField("batch", T.StringType())])
    every = spark.read.schema(schema).parquet(out_root)
    return every.join(F.broadcast(committed) if n <= BROADCAST_CLAIMS else committed, "batch", "left_semi").drop("batch")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Stored particles: committed batches if the folder has a manifest, else all Parquet files below it."""
    commits = batch_status(spark, path).where("status = 'ok'")
    if not commits.head(1):
        return scan_recursive(spark, path)
    first = spark.read.parquet(os.path.join(path, f"batch={commits.first()['claim']}"))
    return read_batches(spark, path, "star" if "formation_time" in first.columns else "dm")


def remove_orphans(spark: SparkSession, out_root: str) -> list[str]:
    """Delete the claimed folders that were never committed; returns their names. Not while a job writes."""
    committed = batch_status(spark, out_root).where("status = 'ok'").select("claim")
    gone = []
    for r in _table(spark, out_root, "claims", CLAIM_SCHEMA).join(committed, "claim", "left_anti").orderBy("claim").collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(out_root, f"batch={r['claim']}"))
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            gone.append(r["claim"])
    return gone


class _Writer:
    """Writes files of one batch to claimed folders and commits them together."""

    def __init__(self, spark: SparkSession, out_root: str, species: str, mode: str, n_files: Optional[int], before_commit: Optional[Hook]) -> None:
        self.spark, self.out_root, self.species, self.mode = spark, out_root, species, mode
        self.n_files, self.before_commit = n_files, before_commit

    def _write(self, files: Sequence[str], batch_id: int) -> list[tuple]:
        """Rows of the manifest for the files: written together, or in halves if that fails."""
        seen = Observation()
        claim = f"{batch_id:06d}-{uuid.uuid4().hex}"
        try:
            batch = read_particle_csv(self.spark, list(files), self.species, mode=self.mode, observation=seen)
            out = batch.repartition(self.n_files) if self.n_files else batch
            _append(self.spark, self.out_root, "claims", [(batch_id, claim)], CLAIM_SCHEMA)
            out.write.option("compression", "snappy").parquet(os.path.join(self.out_root, f"batch={claim}"))
            return [(batch_id, "ok", seen.get["rows"], seen.get["rejected"], claim, list(files), None)]
        except Exception as exc:  # noqa: BLE001 - any error of a file is reported with the file
            if len(files) == 1:
                return [(batch_id, "failed", None, None, None, list(files), f"{type(exc).__name__}: {str(exc)[:500]}")]
        half = len(files) // 2
        return self._write(files[:half], batch_id) + self._write(files[half:], batch_id)

    def __call__(self, files: Sequence[str], batch_id: int) -> list[tuple]:
        rows = self._write(files, batch_id)
        if self.before_commit:
            self.before_commit(batch_id)
        _append(self.spark, self.out_root, "commits", rows, T.StructType(STATUS_SCHEMA.fields[:-1]))
        return rows


def _status(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return _local(spark, rows, T.StructType(STATUS_SCHEMA.fields[:-1])).withColumn("at", F.current_timestamp())


def retry_failed(spark: SparkSession, out_root: str, species: str = "dm", *, mode: str = "PERMISSIVE",
                 n_files: Optional[int] = None, before_commit: Optional[Hook] = None) -> DataFrame:
    """Try again all files that failed and are not committed; returns their new status rows.

    The failed files are few: they are listed on the driver, one write for each batch they came from."""
    write = _Writer(spark, out_root, species, mode, n_files, before_commit)
    by_batch: dict[int, list[str]] = {}
    for r in failed_files(spark, out_root).orderBy("file").collect():
        by_batch.setdefault(r["batch_id"], []).append(r["file"])
    return _status(spark, [row for batch_id, files in by_batch.items() for row in write(files, batch_id)])


def ingest_in_batches(spark: SparkSession, source_dir: str, out_root: str, species: str = "dm", *,
                      files_per_batch: int = 1000, file_glob: str = "*.csv", mode: str = "PERMISSIVE",
                      n_files: Optional[int] = None, checkpoint: Optional[str] = None,
                      recursive: bool = True, before_commit: Optional[Hook] = None) -> DataFrame:
    """Convert every CSV under ``source_dir`` into folders of ``out_root``,
    ``files_per_batch`` files per batch, after retrying what failed in
    earlier runs. Returns this run's status rows; ``read_batches`` reads the data.

    ``before_commit`` is called with the batch's id when its data is written and not yet committed; if it
    raises, the job ends there and the batch is taken up again by the next run with the same checkpoint.
    """
    retried = retry_failed(spark, out_root, species, mode=mode, n_files=n_files, before_commit=before_commit)
    write = _Writer(spark, out_root, species, mode, n_files, before_commit)
    reader = (spark.readStream.format("binaryFile").schema(_FILE_LIST).option("pathGlobFilter", file_glob)
              .option("maxFilesPerTrigger", int(files_per_batch)))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    statuses: list[tuple] = []
    # a batch that is run again: what an earlier run committed stays as it is. The stream gives each file once in a run, so
    # the commits of this run, which come after, aren't needed
    done = committed_files(spark, out_root).withColumnRenamed("file", "path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.join(done, "path", "left_anti").collect())  # at most files_per_batch
        if files:
            statuses.extend(write(files, batch_id))

    ckpt = checkpoint or scratch_path(spark, "ingest-checkpoint")
    query = (reader.load(source_dir).select("path").writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    return retried.unionByName(_status(spark, statuses))
