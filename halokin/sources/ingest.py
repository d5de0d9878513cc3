"""Raw particle CSV and catalogue text -> typed DataFrames -> Parquet.

Files are read by Spark executors straight from the (shared) file system — a
glob or directory, any number of files — never through the driver. Every file
maps by its *own* header names: a first pass reads the first line of each file,
and no more of it, into a table (file, header), by which the files' lines are parsed, so
files with other column orders or extra columns mix freely. ``mode`` follows the
CSV reader: ``PERMISSIVE`` turns unparseable values into NULL (counted by an
``Observation``, listed by ``read_rejects``) and skips files that vanish;
``FAILFAST`` raises on both.
"""

from __future__ import annotations

import csv
import sys
from typing import BinaryIO, Iterable, Iterator, Mapping, Sequence, Union

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import H_CATALOG, SIZE_CUT
from ..schemas import (DM_CSV_COLUMNS, DM_PARTICLES, STAR_CSV_COLUMNS, STAR_PARTICLES, SUBHALOS,
                       SUBHALO_TXT_COLUMNS)
from ..session import materialize, scratch_path
from . import sinks

Paths = Union[str, Sequence[str]]

# what tasks run travels with its code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPECIES_LAYOUT = {
    "star": (STAR_CSV_COLUMNS, STAR_PARTICLES),
    "dm": (DM_CSV_COLUMNS, DM_PARTICLES),
}


def raw_string_schema(names: Iterable[str]) -> T.StructType:
    """All-string schema with the file's header names (typing happens by name later)."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


#: Bytes that are read of a file for its first line, at first; twice as many as long as no line ends there.
HEADER_BYTES = 1 << 16
#: Files whose layouts are broadcast to the lines; beyond that they are joined by a shuffle.
BROADCAST_FILES = 1_000_000


def first_line(stream: BinaryIO) -> str | None:
    """The first line of a UTF-8 stream, of which no more than the blocks that hold it are read; None if it's empty."""
    head, size = b"", HEADER_BYTES
    while True:
        block = stream.read(size)
        head, size = head + block, 2 * size
        end = [i for i in (head.find(b"\n"), head.find(b"\r")) if i >= 0]
        if end or not block:
            return head[: min(end)].decode(errors="replace") if end else head.decode(errors="replace") or None


def _first_lines(spark: SparkSession, paths: Paths, *, recursive: bool, ignore_missing: bool) -> DataFrame:
    """(file, header, opened) of every file, as a plan: Spark lists the files, and tasks open each for its first block only.
    A file isn't opened if Python has no file system for its address."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    listed = source.load(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("file"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            found: list[tuple[str, str | None, bool]] = []
            for name in names:
                try:
                    system, path = pyarrow.fs.FileSystem.from_uri(name)
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    found.append((name, None, False))
                    continue
                try:
                    with system.open_input_stream(path, compression="detect") as stream:
                        found.append((name, first_line(stream), True))
                except FileNotFoundError:
                    if not ignore_missing:
                        raise
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else ([], [], []), (pa.string(), pa.string(), pa.bool_()))],
                                             ["file", "header", "opened"])

    return listed.mapInArrow(read, "file string, header string, opened boolean")


def file_headers(spark: SparkSession, paths: Paths, *, recursive: bool = False, ignore_missing: bool = True) -> DataFrame:
    """(file, header): the first line of every file that has one, as a written table.

    Where Python has no file system for a file's address, Spark itself reads the lines of these files."""
    out = scratch_path(spark, "csv-headers")
    lines = _first_lines(spark, paths, recursive=recursive, ignore_missing=ignore_missing)
    lines.write.parquet(out)
    table = spark.read.schema(lines.schema).parquet(out)
    if not table.where("NOT opened").head(1):
        return table.where("header IS NOT NULL").select("file", "header")
    reader = spark.read.option("recursiveFileLookup", recursive).option("ignoreMissingFiles", ignore_missing)
    lines = reader.text(paths if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return materialize(lines.where("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("header")), "csv-headers")


def _names(header: str, sep: str) -> tuple[str, ...]:
    return tuple(n.strip().lstrip("\ufeff") for n in next(csv.reader([header], delimiter=sep), []))


def _read_by_name(spark: SparkSession, paths: Paths, wanted: Sequence[str], *, sep: str, mode: str, recursive: bool = False,
                  with_file: bool = False) -> DataFrame:
    """The wanted columns, as text, of every file by its own header.

    What reaches the driver are the different headers, from one job. With one header all files are one CSV scan; with more, the
    headers are written as a table, and there is one scan of lines, each parsed by the layout that this table has for its file."""
    lenient = mode.upper() != "FAILFAST"
    table = None
    found = _first_lines(spark, paths, recursive=recursive, ignore_missing=lenient).select("header", "opened").distinct().collect()
    if len({r["header"] for r in found if r["header"] is not None}) > 1 or not all(r["opened"] for r in found):
        table = file_headers(spark, paths, recursive=recursive, ignore_missing=lenient)
        found = table.select("header").distinct().collect()
    headers = sorted(r["header"] for r in found if r["header"] is not None)
    if not headers:
        return spark.createDataFrame([], raw_string_schema([*wanted, "file"] if with_file else wanted))
    layouts = []
    for h in headers:
        names = _names(h, sep)
        if missing := [w for w in wanted if w not in names]:
            table = file_headers(spark, paths, recursive=recursive, ignore_missing=lenient) if table is None else table
            where = table.where(F.col("header") == h).agg(F.count("file").alias("n"), F.min("file").alias("first")).first()
            raise ValueError(f"no column {', '.join(missing)} in the header of {where['n']} files, the first is {where['first']}")
        # only wanted names stay; a repeated name means its first column
        layouts.append(raw_string_schema(n if n in wanted and n not in names[:i] else f"_other{i}" for i, n in enumerate(names)))
    reader = spark.read.option("recursiveFileLookup", True) if recursive else spark.read
    reader = reader.option("ignoreMissingFiles", lenient)
    where = paths if isinstance(paths, str) else list(paths)
    file = [F.col("file")] if with_file else []
    if all(x == layouts[0] for x in layouts):
        raw = reader.schema(layouts[0]).option("header", True).option("sep", sep).option("mode", mode).csv(where)
        return raw.select(*[F.col(f"`{w}`") for w in wanted], *[F.col("_metadata.file_path").alias("file") for _ in file])
    lines = reader.text(where).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = lines.join(F.broadcast(table) if table.count() <= BROADCAST_FILES else table, "file")
    lines = lines.where((F.trim("value") != "") & ~((F.col("start") == 0) & (F.col("value") == F.col("header"))))
    # one struct for each layout, NULL but for its own rows. The number makes this projection one that later filters and
    # projections are not merged into, so that a line is parsed once
    rows = [F.when(F.col("header") == h, F.from_csv("value", ", ".join(f"`{f.name}` string" for f in layout), {"sep": sep, "mode": mode})).alias(f"row{i}")
            for i, (h, layout) in enumerate(zip(headers, layouts))]
    parsed = lines.select(*rows, *file, F.monotonically_increasing_id().alias("number"))
    return parsed.select(*[F.coalesce(*[F.col(f"row{i}")[w] for i in range(len(headers))]).alias(w) for w in wanted], *file)


def _rejected(mapping: Mapping[str, str], schema: T.StructType) -> Column:
    """True if a value is there but can't be cast."""
    types = {f.name: f.dataType for f in schema.fields}
    out = F.lit(False)
    for src, dst in mapping.items():
        c = F.col(f"`{src}`")
        out = out | ((F.trim(c) != "") & c.try_cast(types[dst]).isNull())
    return F.coalesce(out, F.lit(False))


def _typed(raw: DataFrame, mapping: Mapping[str, str], schema: T.StructType, mode: str,
           observation: Observation | None = None) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    if observation is not None:
        raw = raw.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(_rejected(mapping, schema)).alias("rejected"))
    cols: list[Column] = []
    for src, dst in mapping.items():
        c = F.col(f"`{src}`")
        cols.append((c.try_cast(types[dst]) if mode.upper() != "FAILFAST" else c.cast(types[dst])).alias(dst))
    return raw.select(*cols)


def read_particle_csv(spark: SparkSession, paths: Paths, species: str = "star", *, mode: str = "PERMISSIVE", sep: str = ",",
                      recursive: bool = False, observation: Observation | None = None) -> DataFrame:
    """Particle CSV files with a header row -> typed particle DataFrame.

    ``observation`` gets ``rows`` and ``rejected`` (rows with a value that can't be cast) when the result is written."""
    mapping, schema = SPECIES_LAYOUT[species]
    raw = _read_by_name(spark, paths, list(mapping), sep=sep, mode=mode, recursive=recursive)
    return _typed(raw, mapping, schema, mode, observation)


def read_rejects(spark: SparkSession, paths: Paths, species: str = "star", *, sep: str = ",", recursive: bool = False) -> DataFrame:
    """The rows, as text and with their file, of which a value can't be cast."""
    mapping, schema = SPECIES_LAYOUT[species]
    raw = _read_by_name(spark, paths, list(mapping), sep=sep, mode="PERMISSIVE", recursive=recursive, with_file=True)
    return raw.where(_rejected(mapping, schema))


def read_subhalo_text(spark: SparkSession, paths: Paths, *, mode: str = "PERMISSIVE",
                      cut: bool = False, h: float = H_CATALOG) -> DataFrame:
    """Space-separated catalogue text with a header -> typed subhalo catalogue.

    ``cut=True`` applies the size cut ``StarHalfRad * 2 * h > 0.1``.
    """
    raw = _read_by_name(spark, paths, list(SUBHALO_TXT_COLUMNS), sep=" ", mode=mode)
    cat = _typed(raw, SUBHALO_TXT_COLUMNS, SUBHALOS, mode)
    if cut:
        cat = cat.filter(F.col("StarHalfRad") * F.lit(2) * F.lit(h) > F.lit(SIZE_CUT))
    return cat


def ingest_csv(spark: SparkSession, paths: Paths, out: str, species: str = "star", *,
                   mode: str = "PERMISSIVE", n_files: int | None = None,
                   compression: str = "snappy", observation: Observation | None = None) -> DataFrame:
    """One distributed job: read every CSV file, type it, write Snappy Parquet."""
    df = read_particle_csv(spark, paths, species, mode=mode, observation=observation)
    sinks.write_parquet(df, out, compression=compression, n_files=n_files)
    return spark.read.parquet(out)


def empty_particles(spark: SparkSession, species: str = "star") -> DataFrame:
    """Typed empty particle frame (the neutral element of a union of batches)."""
    return spark.createDataFrame([], SPECIES_LAYOUT[species][1])


def scan_recursive(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files anywhere below ``path`` (no partition discovery)."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def scan_batches(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """All batch directories ``root/prefix*`` as one DataFrame (a single scan)."""
    return spark.read.parquet(f"{root}/{prefix}*")


def write_pandas_style_csv(df: DataFrame, path: str, species: str, cell_key: Column | None = None) -> str:
    """Write particles as CSV with the raw header names (``ID``, ``Formation_time``).

    Used to produce raw inputs for the ingest path from derived tables;
    ``cell_key`` groups rows into one directory per spatial cell.
    """
    mapping, _ = SPECIES_LAYOUT[species]
    out = df.select(*[F.col(dst).alias(src) for src, dst in mapping.items()])
    w = out
    if cell_key is not None:
        w = out.withColumn("cell", cell_key)
        w.write.mode("overwrite").option("header", True).partitionBy("cell").csv(path)
    else:
        w.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_subhalo_text(catalog: DataFrame, path: str) -> str:
    """Catalogue as space-separated text with the raw header names."""
    out = catalog.select(*[F.col(dst).alias(src) for src, dst in SUBHALO_TXT_COLUMNS.items()])
    out.write.mode("overwrite").option("header", True).option("sep", " ").csv(path)
    return path
