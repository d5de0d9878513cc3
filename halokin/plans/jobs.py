"""End-to-end jobs over a snapshot: pair tables, kinematics sweeps, exports.

Job structure follows the data flow of the original pipeline, expressed as
Spark jobs: (1) the neighbour join writes one pair table per species; (2) the
kinematics read the pair tables and sweep all apertures and species in one
job; (3) the catalogues are written by DataFrame writers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..constants import BOX_SIZE, FIXED_APERTURES, HALF_RADIUS_SCALES, H_CATALOG, H_JOIN, NOTEBOOK_APERTURES
from ..functions import grid
from ..operators.apertures import suffix_measures
from ..operators.catalog import catalog_2d, catalog_3d, enrich, mass_cut
from ..operators.neighbors import neighbour_join, neighbour_waves
from ..operators.sweep import fixed_apertures, scaled_apertures, sweep
from ..schemas import MEASURES
from ..session import materialize, resumable, scratch_path
from ..sources import fixtures as fx
from ..sources import sinks

_CACHE: dict[tuple, str] = {}


def _source_state(spark: SparkSession, sf_dir: str, tables: Sequence[str]) -> tuple:
    """(path, size, modification time) of the files of the source tables: the
    stored copies of a session are only used while these stay the same."""
    out = []
    for t in tables:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .load(f"{sf_dir}/{t}.parquet").select("path", "length", "modificationTime"))
        out += [tuple(r) for r in files.collect()]
    return tuple(sorted(out))


def _cached_table(spark: SparkSession, sf_dir: str, key: tuple, tag: str, build) -> DataFrame:
    full_key = (spark.sparkContext.applicationId, sf_dir, _source_state(spark, sf_dir, ("supplier", "lineitem")), *key)
    path = _CACHE.get(full_key)
    if path is None:
        path = scratch_path(spark, tag)
        build(path)
        _CACHE[full_key] = path
    return spark.read.parquet(path)


def forget_tables() -> None:
    """Drop the session's memory of stored snapshots and pair tables (after ``remove_scratch``)."""
    _CACHE.clear()


#: Bytes of particles in a stored file, by the width of their types.
FILE_BYTES = 256 * 2**20
#: The same for the snapshot that the queries join: one task sorts the pairs of one such file, each some 450 bytes in the sorter's memory.
JOIN_FILE_BYTES = 6 * 2**20


def files_for(particles: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` the rows make: their count times the width of their types."""
    width = sum({"double": 8, "bigint": 8, "string": 24}.get(f.dataType.simpleString(), 4) for f in particles.schema)
    return max(1, math.ceil(particles.count() * width / file_bytes))


def write_snapshot(particles: DataFrame, path: str, n_files: int | None = None, *, layout: str = "x", box: float = BOX_SIZE,
                   file_bytes: int = FILE_BYTES) -> str:
    """Particles as Parquet in ``n_files`` files (default: by their bytes), ordered in space and over the files.

    ``layout="x"`` orders by ``px``, so that the slab chunks of the neighbour join read their own
    files and row groups only. ``layout="morton"`` orders by the space-filling key of (px, py, pz), so that files and row
    groups are compact in all three coordinates, and a filter on a region of space reads few of them."""
    n = n_files or files_for(particles, file_bytes)
    if layout == "x":
        ordered = particles.repartitionByRange(n, "px").sortWithinPartitions("px")
    elif layout == "morton":
        keyed = particles.withColumn("_key", grid.morton_key("px", "py", "pz", box))
        ordered = keyed.repartitionByRange(n, "_key").sortWithinPartitions("_key").drop("_key")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    ordered.write.mode("overwrite").parquet(path)
    return path


def snapshot_particles(spark: SparkSession, sf_dir: str, species: str, n_files: int | None = None) -> DataFrame:
    """The particle snapshot as stored Parquet (the ingest job's output), written
    once per session and state of the source tables, clustered by x in ``n_files``
    files (default: by their bytes, but no fewer than the session parallelism)."""
    def build(path: str) -> None:
        particles = fx.particles(spark, sf_dir, species)
        write_snapshot(particles, path, n_files or max(spark.sparkContext.defaultParallelism, files_for(particles, JOIN_FILE_BYTES)))

    return _cached_table(spark, sf_dir, ("snapshot", species, n_files), f"snapshot-{species}", build)


@contextmanager
def _a_task_for_each_file(spark: SparkSession) -> Iterator[None]:
    """Within this context a scan doesn't put several files into one task; large files are split as ever."""
    cost, limit = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, spark.conf.get(limit))
    try:
        yield
    finally:
        spark.conf.set(cost, before)


def write_pair_table(pairs: DataFrame | Sequence[DataFrame], path: str) -> str:
    """The neighbour join job's sink: Snappy Parquet, each file sorted by subhalo
    id (a local sort, no shuffle) so that a subhalo-id range filter skips the
    other row groups. A task sorts the pairs of one snapshot file, so its memory follows
    the size of these files and not the size of the snapshot. Waves of pairs (``neighbour_waves``) are written one after the other."""
    waves = [pairs] if isinstance(pairs, DataFrame) else pairs
    for k, wave in enumerate(waves):
        with _a_task_for_each_file(wave.sparkSession):
            wave.sortWithinPartitions("subhalo_id").write.mode("append" if k else "overwrite").parquet(path)
    return path


def pair_table(spark: SparkSession, sf_dir: str, species: str) -> DataFrame:
    """Neighbour pairs of the stored snapshot, written once per session to the
    shared folder and re-read (later jobs scan the Parquet, not the join).

    Each file is sorted by subhalo id (a local sort, no shuffle), so a filter on
    a subhalo-id range skips the other row groups.
    """
    return _cached_table(
        spark, sf_dir, ("pairs", species), f"pairs-{species}",
        lambda path: write_pair_table(
            neighbour_waves(snapshot_particles(spark, sf_dir, species), fx.subhalo_catalog(spark, sf_dir)), path))


def pair_tables(spark: SparkSession, sf_dir: str, species: Sequence[str] = ("star", "dm")) -> dict[str, DataFrame]:
    return {sp: pair_table(spark, sf_dir, sp) for sp in species}


def full_sweep(pairs_by_species: Mapping[str, DataFrame], fixed: Sequence[float] = FIXED_APERTURES,
               scales: Sequence[float] = HALF_RADIUS_SCALES, h: float = H_CATALOG, **opts) -> DataFrame:
    """All fixed and half-radius apertures for all species, one job."""
    aps = fixed_apertures(fixed) + scaled_apertures(scales)
    return sweep(pairs_by_species, aps, h=h, **opts)


def export_catalogs(result: DataFrame, out_root: str) -> dict[str, str]:
    """Write the 3D and 2D catalogues as CSV, one directory per (species, aperture)."""
    paths = {"3d": f"{out_root}/3D", "2d": f"{out_root}/2D"}
    sinks.write_catalog_csv(catalog_3d(result), paths["3d"])
    sinks.write_catalog_csv(catalog_2d(result), paths["2d"])
    return paths


def catalog_job(pairs_by_species: Mapping[str, DataFrame], out_root: str, *, resume: str | None = None, **opts) -> dict[str, str]:
    """All apertures and species: the tidy result table as Parquet (written once),
    then the 3D and 2D CSV catalogues exported from it.

    ``resume`` names a shared folder for the tables of the passes: a job that is started again with it goes on
    from the passes that were finished, if their sources, apertures and options are the same."""
    tidy = f"{out_root}/kinematics"
    with resumable(resume) if resume else nullcontext():
        result = full_sweep(pairs_by_species, **opts)
        result = materialize(result, "sweep") if resume else result
    sinks.write_parquet(result, tidy)
    spark = next(iter(pairs_by_species.values())).sparkSession
    paths = export_catalogs(spark.read.parquet(tidy), out_root)
    return {"kinematics": tidy, **paths}


def partitioned_pairs_job(particles: DataFrame, catalog: DataFrame, radii: DataFrame, out: str, *, h: float = H_JOIN,
                          buckets: int | None = None) -> str:
    """The older pipeline: mass cut, neighbour join, radii joined on by subhalo, pairs partitioned by subhalo.

    ``catalog`` has StarHalfMass, ``radii`` (subhalo_id, StarHalfRad)."""
    heavy = mass_cut(catalog, h=h).drop("StarHalfRad")
    pairs = enrich(neighbour_join(particles, heavy, h=h), radii, "subhalo_id", ["StarHalfRad"])
    return sinks.write_partitioned(pairs, out, "subhalo_id", buckets=buckets)


def notebook_exports(star_pairs: DataFrame, out_root: str, *, h: float = H_JOIN, **opts) -> dict[str, str]:
    """The notebook's seven text files of star kinematics, from one sweep: per aperture (label -> path) a
    space-separated table sorted by subhalo, its measures named with the aperture."""
    tidy = sinks.write_parquet(full_sweep({"star": star_pairs}, NOTEBOOK_APERTURES, (1,), h=h, **opts), f"{out_root}/kinematics")
    result = star_pairs.sparkSession.read.parquet(tidy)
    paths = {}
    for aperture in [f"{r:g}" for r in NOTEBOOK_APERTURES] + ["1Rh"]:
        label = "StarHalfRad" if aperture == "1Rh" else aperture
        rows = result.where(result["aperture"] == aperture).select("subhalo_id", *MEASURES)
        paths[label] = sinks.write_text(suffix_measures(rows, label), f"{out_root}/vdisp{label}")
    return paths
