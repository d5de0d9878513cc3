"""Registered queries for the remaining inventory: ingest and scans, sinks,
projections and filters, grid and vector expressions, inspection aggregates,
and the window-style group totals. Each has a DuckDB oracle where the result
is a table SQL can produce."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..constants import GRID_CELLS, H_CATALOG, H_JOIN, NOTEBOOK_APERTURES, dm_particle_mass
from ..functions import grid
from ..functions.vectors import cross, dot, norm, scale, unit, vec
from ..operators import apertures as ap
from ..operators import stats
from ..operators.catalog import enrich, mass_cut, size_cut
from ..operators.joinback import group_totals
from ..operators.kinematics import kinematics, velocity_moments
from ..operators.neighbors import particle_cells, rename_subhalos
from ..schemas import MEASURES
from ..session import resumable, scratch_path, tables_of
from ..sources import fixtures as fx
from ..sources import ingest, sinks
from ..streaming.batched_ingest import ingest_in_batches, read_batches
from . import jobs
from . import oracle as O
from .registry import NOISE, quantize, register, rounded

H = H_CATALOG
MDM = dm_particle_mass(H)
STAR_COLS = O.PARTICLE_COLUMNS["star"]


def _cells():
    """Ten x-slabs of the box: the raw CSV files are written one directory per slab."""
    return F.pmod(F.floor(F.col("px") / F.lit(20500.0)), F.lit(10)).cast("int")


def _raw_csv(spark: SparkSession, d: str, species: str) -> str:
    path = scratch_path(spark, f"raw-{species}-csv")
    ingest.write_pandas_style_csv(fx.particles(spark, d, species), path, species, cell_key=_cells())
    return path


# ------------------------------------------------------------------ ingest, scans, sinks

@register("ingest_star_csv", O.particles_sql("star"))
def ingest_star_csv(spark: SparkSession, d: str) -> DataFrame:
    """CSV files (one directory per spatial cell) -> typed Parquet -> re-read."""
    raw = _raw_csv(spark, d, "star")
    return ingest.ingest_csv(spark, f"{raw}/*/*.csv", scratch_path(spark, "star-parquet"), "star")


@register("ingest_dm_csv", O.particles_sql("dm"))
def ingest_dm_csv(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw_csv(spark, d, "dm")
    return ingest.ingest_csv(spark, f"{raw}/*/*.csv", scratch_path(spark, "dm-parquet"), "dm")


_SIZE_CUT_SQL = f"SELECT * FROM ({O.subhalos_sql()}) s WHERE StarHalfRad * 2 * {O.dbl(H)} > {O.dbl(O.SIZE_CUT)}"


@register("ingest_subhalo_txt", _SIZE_CUT_SQL)
def ingest_subhalo_txt(spark: SparkSession, d: str) -> DataFrame:
    """Space-separated catalogue text -> typed catalogue with the size cut."""
    path = scratch_path(spark, "subhalo-txt")
    ingest.write_subhalo_text(fx.subhalo_catalog(spark, d), path)
    return ingest.read_subhalo_text(spark, path, cut=True)


def _batches(spark: SparkSession, d: str, species: str) -> str:
    raw = _raw_csv(spark, d, species)
    out = scratch_path(spark, f"{species}-batches")
    ingest_in_batches(spark, raw, out, species, files_per_batch=3)
    return out


@register("ingest_batched", O.particles_sql("dm"))
def ingest_batched(spark: SparkSession, d: str) -> DataFrame:
    """Batched, resumable ingest (3 files per batch); all committed batches re-read."""
    return read_batches(spark, _batches(spark, d, "dm"), "dm")


def _other_layouts(spark: SparkSession, d: str) -> str:
    """Star CSV files in three layouts: as given, reversed, and with an extra column amid the others."""
    raw = scratch_path(spark, "raw-mixed")
    p = fx.star_particles(spark, d)
    names = {dst: src for src, dst in ingest.SPECIES_LAYOUT["star"][0].items()}
    cols = [F.col(c).alias(names[c]) for c in p.columns]
    layouts = (cols, cols[::-1], [*cols[:3], F.lit("x").alias("note"), *cols[3:]])
    for k, layout in enumerate(layouts):
        p.where(F.pmod("id", F.lit(3)) == k).select(*layout).write.option("header", True).csv(f"{raw}/cell={k}")
    return raw


@register("ingest_mixed_headers", O.particles_sql("star"))
def ingest_mixed_headers(spark: SparkSession, d: str) -> DataFrame:
    """Files with different column orders and an extra column: each maps by its own header."""
    return ingest.ingest_csv(spark, f"{_other_layouts(spark, d)}/*/*.csv", scratch_path(spark, "star-mixed"), "star")


@register("ingest_batched_mixed", O.particles_sql("star"))
def ingest_batched_mixed(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "star-mixed-batches")
    ingest_in_batches(spark, _other_layouts(spark, d), out, "star", files_per_batch=2)
    return read_batches(spark, out, "star")


def _bad_cell(spark: SparkSession, d: str) -> tuple[str, Callable[[], None]]:
    """Dark-matter CSV files by cell, those of cell 3 without a needed column; and what mends these files in place."""
    p = fx.dm_particles(spark, d).withColumn("cell", _cells())
    raw, mended = scratch_path(spark, "raw-retry"), scratch_path(spark, "mended")
    names = {dst: src for src, dst in ingest.SPECIES_LAYOUT["dm"][0].items()}
    good = p.select("cell", *[F.col(c).alias(names[c]) for c in names])
    third = good.where("cell = 3").drop("cell")
    good.where("cell <> 3").write.option("header", True).partitionBy("cell").csv(raw)
    third.withColumnRenamed("px", "lost").write.option("header", True).csv(f"{raw}/cell=3")
    third.write.option("header", True).csv(mended)

    def mend() -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(raw)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        bad, right = ([x.getPath() for x in fs.globStatus(hadoop.Path(f"{folder}/part-*"))] for folder in (f"{raw}/cell=3", mended))
        for old, new in zip(sorted(bad, key=str), sorted(right, key=str), strict=True):  # written alike, so as many files
            fs.delete(old, False)
            fs.rename(new, old)

    return raw, mend


@register("ingest_batched_retry", O.particles_sql("dm"))
def ingest_batched_retry(spark: SparkSession, d: str) -> DataFrame:
    """Files without a needed column fail alone; mended, the next run of the same job takes them up."""
    raw, mend = _bad_cell(spark, d)
    out, ckpt = (scratch_path(spark, t) for t in ("retry-batches", "retry-checkpoint"))
    run = lambda: ingest_in_batches(spark, raw, out, "dm", files_per_batch=4, checkpoint=ckpt)
    failed = [f for r in run().where("status = 'failed'").select("files").collect() for f in r["files"]]
    if not failed or any("/cell=3/" not in f for f in failed):
        raise AssertionError(f"expected the files of cell 3 to fail, got {failed}")
    mend()
    run()
    return read_batches(spark, out, "dm")


@register("ingest_batched_recovered", O.particles_sql("dm"))
def ingest_batched_recovered(spark: SparkSession, d: str) -> DataFrame:
    """The job is lost again and again between the write of a batch and its commit (a split batch among them, and the retry of
    mended files); what it left behind is not read, and every file is there once in the end."""
    raw, mend = _bad_cell(spark, d)
    out, ckpt = (scratch_path(spark, t) for t in ("lost-batches", "lost-checkpoint"))
    lost: set[tuple[str, int]] = set()

    def run(stage: str) -> bool:
        def lose_once(batch_id: int) -> None:
            if (stage, batch_id) not in lost:
                lost.add((stage, batch_id))
                raise RuntimeError(f"lost before the commit of batch {batch_id}")

        try:
            ingest_in_batches(spark, raw, out, "dm", files_per_batch=4, checkpoint=ckpt, before_commit=lose_once)
            return True
        except Exception as exc:  # noqa: BLE001 - the simulated loss, as the stream reports it
            if "lost before the commit" not in str(exc):
                raise
            return False

    for stage in ("first", "mended"):
        while not run(stage):
            pass
        if stage == "first":
            mend()
    return read_batches(spark, out, "dm")


@register("scan_batches", O.particles_sql("star"))
def scan_batches(spark: SparkSession, d: str) -> DataFrame:
    """Union of all batch directories by one glob scan."""
    return ingest.scan_batches(spark, _batches(spark, d, "star"), "batch=")


@register("scan_recursive", O.particles_sql("star"))
def scan_recursive(spark: SparkSession, d: str) -> DataFrame:
    """Parquet files at any depth below a root (hidden ``_status`` ignored)."""
    return ingest.scan_recursive(spark, _batches(spark, d, "star"))


@register("roundtrip_parquet", O.particles_sql("star"))
def roundtrip_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.write_parquet(fx.star_particles(spark, d), scratch_path(spark, "star-snappy"))
    return spark.read.parquet(path)


@register("roundtrip_codecs", O.particles_sql("star"))
def roundtrip_codecs(spark: SparkSession, d: str) -> DataFrame:
    """A third of the particles with each of three codecs, appended to one folder and read back as one table."""
    path = scratch_path(spark, "star-codecs")
    p = fx.star_particles(spark, d)
    for k, codec in enumerate(("snappy", "gzip", "zstd")):
        sinks.write_parquet(p.where(F.pmod("id", F.lit(3)) == k), path, mode="append", compression=codec)
    return spark.read.parquet(path)


@register("sink_modes", O.particles_sql("star"))
def sink_modes(spark: SparkSession, d: str) -> DataFrame:
    """The four writer modes after each other: only overwrite and append change what is there."""
    path = scratch_path(spark, "star-modes")
    p = fx.star_particles(spark, d)
    even, odd = p.where("id % 2 = 0"), p.where("id % 2 <> 0")
    sinks.write_parquet(odd, path, mode="error")  # a new folder
    sinks.write_parquet(even, path, mode="overwrite")
    sinks.write_parquet(even, path, mode="ignore")
    sinks.write_parquet(odd, path, mode="append")
    try:
        sinks.write_parquet(even, path, mode="error")
    except AnalysisException:
        return spark.read.parquet(path)
    raise AssertionError("a folder that exists was written in mode error")


_REGION = "px BETWEEN 30000 AND 90000 AND py BETWEEN 60000 AND 120000 AND pz BETWEEN 20000 AND 100000"


@register("snapshot_region", f"SELECT * FROM ({O.particles_sql('star')}) p WHERE {_REGION}")
def snapshot_region(spark: SparkSession, d: str) -> DataFrame:
    """The particles of a box-shaped region, from a snapshot stored along a space-filling curve."""
    path = jobs.write_snapshot(fx.star_particles(spark, d), scratch_path(spark, "star-morton"), 16, layout="morton")
    return spark.read.parquet(path).where(_REGION)


@register("roundtrip_partitioned", O.pairs_sql("star"))
def roundtrip_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Pairs written Hive-partitioned by subhalo_id and read back."""
    path = sinks.write_partitioned(jobs.pair_table(spark, d, "star"), scratch_path(spark, "pairs-by-subhalo"))
    return sinks.read_partitioned(spark, path)


_EXPORT_SCHEMA = T.StructType([T.StructField("subhalo_id", T.IntegerType())] +
                              [T.StructField(m, T.DoubleType()) for m in MEASURES])


@register("export_txt", O.kin_fixed_sql("star", 30, H))
def export_txt(spark: SparkSession, d: str) -> DataFrame:
    """Kinematics written as space-separated text sorted by subhalo, re-read."""
    res = ap.aperture_kinematics(jobs.pair_table(spark, d, "star"), 30, "star", h=H, **NOISE)
    path = sinks.write_text(res, scratch_path(spark, "kin30-txt"))
    back = spark.read.schema(_EXPORT_SCHEMA).option("header", True).option("sep", " ").csv(path)
    return rounded(back)


def _catalog_back(spark: SparkSession, d: str, which: str, mapping) -> DataFrame:
    """The catalogue job on both species, its CSV of one kind read back."""
    paths = jobs.catalog_job(jobs.pair_tables(spark, d), scratch_path(spark, "catalogs"), **NOISE)
    schema = T.StructType([T.StructField("subhalo_id", T.IntegerType())] +
                          [T.StructField(dst, T.DoubleType()) for _, dst in mapping] +
                          [T.StructField("species", T.StringType()), T.StructField("aperture", T.StringType())])
    return rounded(spark.read.schema(schema).option("header", True).csv(paths[which]))


@register("export_catalog_csv", O.catalog_sql("3d"))
def export_catalog_csv(spark: SparkSession, d: str) -> DataFrame:
    """3D catalogue written as CSV per (species, aperture), read back."""
    return _catalog_back(spark, d, "3d", O.CATALOG_3D)


@register("catalog_resumed", O.catalog_sql("3d"))
def catalog_resumed(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue job is lost after the passes of its sweep that write a table; started again, it goes on from that table."""
    resume = scratch_path(spark, "resume")
    pairs = jobs.pair_tables(spark, d)
    with resumable(resume):
        jobs.full_sweep(pairs, **NOISE)  # writes the axis table; its result is lost before it is used
    made = tables_of(spark, resume)
    paths = jobs.catalog_job(pairs, scratch_path(spark, "catalogs"), resume=resume, **NOISE)
    if not made or not made < tables_of(spark, resume) or len([t for t in tables_of(spark, resume) if t.startswith("kin-J")]) != 1:
        raise AssertionError("a finished pass was made again")
    schema = T.StructType([T.StructField("subhalo_id", T.IntegerType())] + [T.StructField(dst, T.DoubleType()) for _, dst in O.CATALOG_3D] +
                          [T.StructField("species", T.StringType()), T.StructField("aperture", T.StringType())])
    return rounded(spark.read.schema(schema).option("header", True).csv(paths["3d"]))


@register("export_catalog_2d_csv", O.catalog_sql("2d"))
def export_catalog_2d_csv(spark: SparkSession, d: str) -> DataFrame:
    """2D catalogue written as CSV per (species, aperture), read back."""
    return _catalog_back(spark, d, "2d", O.CATALOG_2D)


_NOTEBOOK_SQL = (f"SELECT CASE WHEN aperture = '1Rh' THEN 'StarHalfRad' ELSE aperture END AS aperture, subhalo_id, {', '.join(MEASURES)} "
                 f"FROM ({O.sweep_sql(('star',), NOTEBOOK_APERTURES, (1,), h=H_JOIN)}) s")


@register("export_notebook_txt", _NOTEBOOK_SQL)
def export_notebook_txt(spark: SparkSession, d: str) -> DataFrame:
    """The seven text files of the notebook, written by one job and read back."""
    paths = jobs.notebook_exports(jobs.pair_table(spark, d, "star"), scratch_path(spark, "notebook"), **NOISE)
    out = None
    for label, path in paths.items():
        part = spark.read.schema(_EXPORT_SCHEMA).option("header", True).option("sep", " ").csv(path)
        part = rounded(part).select(F.lit(label).alias("aperture"), "subhalo_id", *MEASURES)
        out = part if out is None else out.unionByName(part)
    return out


_OLD_PAIRS_SQL = (f"SELECT p.*, s.StarHalfMass AS subhalo_StarHalfMass FROM ({O.pairs_sql('star')}) p "
                  f"JOIN ({O.subhalos_sql(with_half_mass=True)}) s ON p.subhalo_id = s.sub_id "
                  f"WHERE s.StarHalfMass / {O.dbl(H_JOIN)} > {O.dbl(O.MASS_CUT)}")


@register("partitioned_pairs_job", _OLD_PAIRS_SQL)
def partitioned_pairs_job(spark: SparkSession, d: str) -> DataFrame:
    """The older pipeline end to end: mass cut, join, radii, pairs partitioned by subhalo, read back."""
    out = jobs.partitioned_pairs_job(jobs.snapshot_particles(spark, d, "star"), fx.subhalo_catalog(spark, d, with_half_mass=True),
                                     fx.radius_side_table(spark, d), scratch_path(spark, "old-pairs"))
    return sinks.read_partitioned(spark, out)


# ------------------------------------------------------------------ projections and filters

_RENAMED_SQL = ("SELECT px AS subhalo_px, py AS subhalo_py, pz AS subhalo_pz, vx AS subhalo_vx, "
                "vy AS subhalo_vy, vz AS subhalo_vz, sub_id AS subhalo_id, StarHalfRad "
                f"FROM ({O.subhalos_sql()}) s")


@register("subhalo_renamed", _RENAMED_SQL)
def subhalo_renamed(spark: SparkSession, d: str) -> DataFrame:
    return rename_subhalos(fx.subhalo_catalog(spark, d))


@register("subhalo_size_cut", _SIZE_CUT_SQL)
def subhalo_size_cut(spark: SparkSession, d: str) -> DataFrame:
    return size_cut(fx.subhalo_catalog(spark, d), h=H)


_MASS_CUT_SQL = (
    "SELECT px AS subhalo_px, py AS subhalo_py, pz AS subhalo_pz, vx AS subhalo_vx, vy AS subhalo_vy, "
    "vz AS subhalo_vz, StarHalfMass AS subhalo_StarHalfMass, sub_id AS subhalo_id, StarHalfRad "
    f"FROM ({O.subhalos_sql(with_half_mass=True)}) s WHERE StarHalfMass / {O.dbl(H_JOIN)} > {O.dbl(O.MASS_CUT)}")


@register("subhalo_mass_cut", _MASS_CUT_SQL)
def subhalo_mass_cut(spark: SparkSession, d: str) -> DataFrame:
    return rename_subhalos(mass_cut(fx.subhalo_catalog(spark, d, with_half_mass=True), h=H_JOIN))


@register("dm_constant_mass", f"SELECT *, {O.dbl(MDM)} AS mass FROM ({O.particles_sql('dm')}) p")
def dm_constant_mass(spark: SparkSession, d: str) -> DataFrame:
    return ap.with_constant_mass(fx.dm_particles(spark, d), MDM)


_UNION_SQL = (f"SELECT 'star' AS species, {', '.join(c for c in STAR_COLS if c != 'formation_time')} "
              f"FROM ({O.particles_sql('star')}) s UNION ALL "
              f"SELECT 'dm' AS species, px, py, pz, vx, vy, vz, CAST({O.dbl(MDM)} AS FLOAT) AS mass, id "
              f"FROM ({O.particles_sql('dm')}) d")


@register("union_species", _UNION_SQL)
def union_species(spark: SparkSession, d: str) -> DataFrame:
    """Star and dark-matter particles in one frame (dark matter at its constant mass)."""
    cols = ["px", "py", "pz", "vx", "vy", "vz", "mass", "id"]
    star = fx.star_particles(spark, d).select(F.lit("star").alias("species"), *cols)
    dm = fx.dm_particles(spark, d).withColumn("mass", F.lit(MDM).cast("float")).select(
        F.lit("dm").alias("species"), *cols)
    return star.unionByName(dm)


def _ap_rows_sql(where: str) -> str:
    return (f"SELECT subhalo_id, id, px, py, pz, sq_dist_subhalo2ptl FROM ({O.pairs_sql('star')}) p "
            f"WHERE {where}")


@register("aperture_fixed_r5", _ap_rows_sql(f"sq_dist_subhalo2ptl <= {O.dbl((5 * H) * (5 * H))}"))
def aperture_fixed_r5(spark: SparkSession, d: str) -> DataFrame:
    return ap.fixed_aperture(jobs.pair_table(spark, d, "star"), 5, H).select(
        "subhalo_id", "id", "px", "py", "pz", "sq_dist_subhalo2ptl")


_RH2 = O.scaled_radius_sql(2, h=H)


@register("aperture_scaled_rh2", _ap_rows_sql(f"sq_dist_subhalo2ptl <= ({_RH2}) * ({_RH2})"))
def aperture_scaled_rh2(spark: SparkSession, d: str) -> DataFrame:
    return ap.scaled_aperture(jobs.pair_table(spark, d, "star"), "StarHalfRad", 2, H).select(
        "subhalo_id", "id", "px", "py", "pz", "sq_dist_subhalo2ptl")


_KIN30 = O.kin_fixed_sql("star", 30, H)
# FIXED VALUES: the measures' names with the aperture, in the order of MEASURES.
NAMES_30 = """
total_kinetic_energy_30
mass_weighted_velocity_dispersion_30_x
mass_weighted_velocity_dispersion_30_y
mass_weighted_velocity_dispersion_30_z
mass_weighted_velocity_dispersion_30
rotation_kinetic_energy_30
mass_weighted_rotation_velocity_30
mass_weighted_velocity_dispersion_30_r
mass_weighted_velocity_dispersion_30_theta
mass_weighted_velocity_dispersion_30_phi
mass_weighted_velocity_dispersion_30_phi_no_rotation
mass_weighted_velocity_dispersion_30_no_rotation
mass_weighted_velocity_dispersion_30_x_no_rotation
mass_weighted_velocity_dispersion_30_y_no_rotation
mass_weighted_velocity_dispersion_30_z_no_rotation
""".split()
_SUFFIX_SQL = "SELECT subhalo_id, " + ", ".join(f"{m} AS {n}" for m, n in zip(MEASURES, NAMES_30)) + f" FROM ({_KIN30}) k"


@register("kin_suffix", _SUFFIX_SQL)
def kin_suffix(spark: SparkSession, d: str) -> DataFrame:
    """Notebook naming: measures carry the aperture in their names."""
    res = ap.aperture_kinematics(jobs.pair_table(spark, d, "star"), 30, "star", h=H, suffix="30", **NOISE)
    return res.select("subhalo_id", *[quantize(F.col(c), O.MEASURE_DECIMALS).alias(c) for c in res.columns if c != "subhalo_id"])


# A group whose J is 7.5e-9 of the size of its terms, in whole numbers: two pairs of particles on opposite
# sides, 8192 * 8192 against 8191 * 8193.
_SMALL_J = ((8192, 8192), (-8192, -8192), (8191, -8193), (-8191, 8193))
_SMALL_J_ROWS = " UNION ALL ".join(
    f"SELECT s_suppkey AS subhalo_id, {O.dbl(x)} AS rel_px, {O.dbl(0)} AS rel_py, {O.dbl(0)} AS rel_pz, {O.dbl(x * x)} AS sq_dist_subhalo2ptl, "
    f"{O.dbl(0)} AS vx, {O.dbl(v)} AS vy, {O.dbl(0)} AS vz, CAST(1 + s_suppkey % 4 AS DOUBLE) AS mass FROM supplier" for x, v in _SMALL_J)


@register("kin_small_j", O.kinematics_sql(_SMALL_J_ROWS, ["subhalo_id"], j_noise=None))
def kin_small_j(spark: SparkSession, d: str) -> DataFrame:
    """A small but real J is no noise: the group is kept with all its measures."""
    rows = None
    for x, v in _SMALL_J:
        part = fx.table(spark, d, "supplier").selectExpr(
            "s_suppkey AS subhalo_id", f"double({x}) AS rel_px", "double(0) AS rel_py", "double(0) AS rel_pz", f"double({x * x}) AS sq_dist_subhalo2ptl",
            "double(0) AS vx", f"double({v}) AS vy", "double(0) AS vz", "double(1 + s_suppkey % 4) AS mass")
        rows = part if rows is None else rows.unionByName(part)
    return rounded(kinematics(rows))


_LONG_ID = "CAST(subhalo_id AS BIGINT) * 8589934592 - 10737418240"


@register("sweep_long_ids", O.sweep_sql(("star", "dm"), (10, 20), (1,), subhalo_id=_LONG_ID))
def sweep_long_ids(spark: SparkSession, d: str) -> DataFrame:
    """Subhalo ids beyond 32 bits, below zero too, equal in their low bits."""
    pairs = {sp: df.withColumn("subhalo_id", F.expr(_LONG_ID)) for sp, df in jobs.pair_tables(spark, d).items()}
    return rounded(jobs.full_sweep(pairs, (10, 20), (1,), **NOISE))


_SMALL_RADII = "CAST(CAST(StarHalfRad AS DOUBLE) / 100 AS FLOAT)"


@register("subhalo_size_cut_small", f"SELECT * FROM (SELECT * REPLACE ({_SMALL_RADII} AS StarHalfRad) FROM ({O.subhalos_sql()}) s0) s "
                                    f"WHERE StarHalfRad * 2 * {O.dbl(H)} > {O.dbl(O.SIZE_CUT)}")
def subhalo_size_cut_small(spark: SparkSession, d: str) -> DataFrame:
    """The size cut on radii of which it rejects a part."""
    return size_cut(fx.subhalo_catalog(spark, d).withColumn("StarHalfRad", F.expr(_SMALL_RADII)), h=H)


# ------------------------------------------------------------------ grid and vector expressions

_CELL = O.dbl(grid.cell_size())
_GRID_SQL = (f"SELECT id, px, py, pz, ix, iy, iz, ((ix % {GRID_CELLS}) + {GRID_CELLS}) % {GRID_CELLS} AS cx, "
             f"((iy % {GRID_CELLS}) + {GRID_CELLS}) % {GRID_CELLS} AS cy, "
             f"((iz % {GRID_CELLS}) + {GRID_CELLS}) % {GRID_CELLS} AS cz FROM ("
             f"SELECT *, CAST(floor(CAST(px AS DOUBLE) / {_CELL}) AS INTEGER) AS ix, "
             f"CAST(floor(CAST(py AS DOUBLE) / {_CELL}) AS INTEGER) AS iy, "
             f"CAST(floor(CAST(pz AS DOUBLE) / {_CELL}) AS INTEGER) AS iz FROM ({O.particles_sql('star')}) p) q")


@register("grid_cell", _GRID_SQL)
def grid_cell(spark: SparkSession, d: str) -> DataFrame:
    return particle_cells(fx.star_particles(spark, d)).select(
        "id", "px", "py", "pz", "ix", "iy", "iz", "cx", "cy", "cz")


@register("grid_occupancy", f"SELECT cx, cy, cz, COUNT(*) AS n FROM ({_GRID_SQL}) g GROUP BY cx, cy, cz")
def grid_occupancy(spark: SparkSession, d: str) -> DataFrame:
    """Particles per grid cell (partial aggregation: a dense cell is reduced map-side)."""
    return particle_cells(fx.star_particles(spark, d)).groupBy("cx", "cy", "cz").agg(
        F.count(F.lit(1)).alias("n"))


_ADJ_SQL = (f"SELECT subhalo_id, id, px, py, pz, subhalo_ix, subhalo_iy, subhalo_iz, ix, iy, iz "
            f"FROM ({O.pairs_sql('star')}) p WHERE "
            + " AND ".join(f"least(abs(i{a} - subhalo_i{a}), {GRID_CELLS} - abs(i{a} - subhalo_i{a})) <= 1"
                           for a in "xyz"))


@register("grid_adjacent", _ADJ_SQL)
def grid_adjacent(spark: SparkSession, d: str) -> DataFrame:
    """Neighbour pairs whose cells satisfy the periodic adjacency predicate (all of them)."""
    p = jobs.pair_table(spark, d, "star")
    cond = None
    for a in "xyz":
        c = grid.periodic_adjacent(F.col(f"i{a}"), F.col(f"subhalo_i{a}"))
        cond = c if cond is None else cond & c
    return p.filter(cond).select("subhalo_id", "id", "px", "py", "pz", "subhalo_ix", "subhalo_iy",
                                 "subhalo_iz", "ix", "iy", "iz")


_SHIFTED_SQL = (f"SELECT * FROM (SELECT subhalo_id, id, px, py, pz, subhalo_ix, ix + id % 5 AS ix FROM ({O.pairs_sql('star')}) p) q "
                f"WHERE least(abs(ix - subhalo_ix), {GRID_CELLS} - abs(ix - subhalo_ix)) <= 1")


@register("grid_adjacent_shifted", _SHIFTED_SQL)
def grid_adjacent_shifted(spark: SparkSession, d: str) -> DataFrame:
    """The adjacency predicate on cells moved by 0 to 4, of which it rejects a part."""
    p = jobs.pair_table(spark, d, "star").withColumn("ix", F.col("ix") + F.col("id") % 5)
    return p.where(grid.periodic_adjacent(F.col("ix"), F.col("subhalo_ix"))).select("subhalo_id", "id", "px", "py", "pz", "subhalo_ix", "ix")


@register("min_image", f"SELECT subhalo_id, id, px, py, pz, rel_px, rel_py, rel_pz FROM ({O.pairs_sql('star')}) p")
def min_image(spark: SparkSession, d: str) -> DataFrame:
    """Minimum-image displacement of every neighbour pair."""
    return jobs.pair_table(spark, d, "star").select("subhalo_id", "id", "px", "py", "pz",
                                                    "rel_px", "rel_py", "rel_pz")


_VEC_SQL = f"""
SELECT subhalo_id, id, px, py, pz, r, x / NULLIF(r, 0) AS rhat_x, y / NULLIF(r, 0) AS rhat_y,
       z / NULLIF(r, 0) AS rhat_z, (y * vz - z * vy) * m AS j_x, (z * vx - x * vz) * m AS j_y,
       (x * vy - y * vx) * m AS j_z, x * vx + y * vy + z * vz AS x_dot_v
FROM (SELECT subhalo_id, id, px, py, pz, rel_px AS x, rel_py AS y, rel_pz AS z,
             CAST(vx AS DOUBLE) AS vx, CAST(vy AS DOUBLE) AS vy, CAST(vz AS DOUBLE) AS vz,
             CAST(mass AS DOUBLE) AS m, sqrt(rel_px * rel_px + rel_py * rel_py + rel_pz * rel_pz) AS r
      FROM ({O.pairs_sql('star')}) p) q"""


@register("vec_ops", _VEC_SQL)
def vec_ops(spark: SparkSession, d: str) -> DataFrame:
    """Norm, unit vector, cross and dot products on the pair table."""
    p = jobs.pair_table(spark, d, "star")
    x = vec("rel_p")
    v = vec("v", cast="double")
    m = F.col("mass").cast("double")
    rhat = unit(x)
    j = scale(cross(x, v), m)
    return p.select("subhalo_id", "id", "px", "py", "pz", norm(x).alias("r"),
                    *[c.alias(f"rhat_{a}") for c, a in zip(rhat, "xyz")],
                    *[c.alias(f"j_{a}") for c, a in zip(j, "xyz")], dot(x, v).alias("x_dot_v"))


# ------------------------------------------------------------------ joins and aggregates

@register("enrich_catalog", O.pairs_sql("star"))
def enrich_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Pair table without the radius column, enriched from the (subhalo_id, StarHalfRad) side table."""
    pairs = jobs.pair_table(spark, d, "star").drop("StarHalfRad")
    return enrich(pairs, fx.radius_side_table(spark, d), "subhalo_id", ["StarHalfRad"])


@register("enrich_side_wins", O.pairs_sql("star"))
def enrich_side_wins(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that have a radius column of their own, enriched: the side table's values stand, without a second column."""
    pairs = jobs.pair_table(spark, d, "star").withColumn("StarHalfRad", F.lit(-1.0).cast("float"))
    return enrich(pairs, fx.radius_side_table(spark, d))


def _rows30(species: str = "star") -> str:
    return O.fixed_rows_sql(species, 30, H)


def _moments_sql(rows_sql: str) -> str:
    body = O.kinematics_sql(rows_sql, ["subhalo_id"])
    # the moments are the all-row part of the chain: take them from its 'tot' CTE
    head = body.split("jraw AS (")[0].rstrip().rstrip(",")
    q = lambda e, n: f"{O.qround(e, O.MEASURE_DECIMALS)} AS {n}"
    return (head + f"\nSELECT subhalo_id, {q('Ktot', MEASURES[0])}, {q('Sx / NULLIF(mtot, 0)', MEASURES[1])}, "
            f"{q('Sy / NULLIF(mtot, 0)', MEASURES[2])}, {q('Sz / NULLIF(mtot, 0)', MEASURES[3])}, "
            f"{q('Sx / NULLIF(mtot, 0) + Sy / NULLIF(mtot, 0) + Sz / NULLIF(mtot, 0)', MEASURES[4])} FROM tot")


_MOMENTS30 = _moments_sql(_rows30())


@register("kinetic_energy", f"SELECT subhalo_id, {MEASURES[0]} FROM ({_MOMENTS30}) t")
def kinetic_energy(spark: SparkSession, d: str) -> DataFrame:
    """Total kinetic energy of every subhalo in the 30 kpc aperture (all subhalos)."""
    rows = ap.fixed_aperture(jobs.pair_table(spark, d, "star"), 30, H)
    return rounded(velocity_moments(rows).select("subhalo_id", MEASURES[0]))


@register("weighted_dispersion", _MOMENTS30)
def weighted_dispersion(spark: SparkSession, d: str) -> DataFrame:
    """Mass-weighted Cartesian velocity variances of every subhalo (30 kpc)."""
    rows = ap.fixed_aperture(jobs.pair_table(spark, d, "star"), 30, H)
    return rounded(velocity_moments(rows))


@register("rotation_velocity", f"SELECT subhalo_id, {MEASURES[6]} FROM ({_KIN30}) k")
def rotation_velocity(spark: SparkSession, d: str) -> DataFrame:
    """sum(mV_rot over valid rows) / M(all rows) per subhalo (30 kpc)."""
    rows = ap.fixed_aperture(jobs.pair_table(spark, d, "star"), 30, H)
    return rounded(kinematics(rows, **NOISE).select("subhalo_id", MEASURES[6]))


def _win_rows_sql() -> str:
    return (f"SELECT subhalo_id, id, px, py, pz, CAST(mass AS DOUBLE) AS m, CAST(vx AS DOUBLE) AS vx, "
            f"CAST(vy AS DOUBLE) AS vy, CAST(vz AS DOUBLE) AS vz, rel_px AS x, rel_py AS y, rel_pz AS z "
            f"FROM ({O.pairs_sql('star')}) p WHERE sq_dist_subhalo2ptl <= {O.dbl((30 * H) * (30 * H))}")


_WIN_MASS_SQL = (f"SELECT subhalo_id, id, px, py, pz, m AS mass, SUM(m) OVER (PARTITION BY subhalo_id) AS mass_sum "
                 f"FROM ({_win_rows_sql()}) w")
_WIN_VEL_SQL = (f"SELECT subhalo_id, id, px, py, pz, "
                + ", ".join(f"SUM(m * v{a}) OVER (PARTITION BY subhalo_id) / SUM(m) OVER (PARTITION BY subhalo_id) "
                            f"AS v{a}_avg" for a in "xyz")
                + f" FROM ({_win_rows_sql()}) w")
_WIN_J_SQL = (f"SELECT subhalo_id, id, px, py, pz, "
              + ", ".join(f"{O.qround(f'SUM(({e}) * m) OVER (PARTITION BY subhalo_id)', O.MEASURE_DECIMALS)} "
                          f"AS j_tot_{a}" for a, e in zip("xyz", ("y * uz - z * uy", "z * ux - x * uz",
                                                                   "x * uy - y * ux")))
              + f" FROM (SELECT *, vx - vx_avg AS ux, vy - vy_avg AS uy, vz - vz_avg AS uz FROM ("
              + f"SELECT *, " + ", ".join(
                  f"SUM(m * v{a}) OVER (PARTITION BY subhalo_id) / SUM(m) OVER (PARTITION BY subhalo_id) AS v{a}_avg"
                  for a in "xyz") + f" FROM ({_win_rows_sql()}) w0) w1) w")


def _win_rows(spark: SparkSession, d: str) -> DataFrame:
    p = ap.fixed_aperture(jobs.pair_table(spark, d, "star"), 30, H)
    return p.select("subhalo_id", "id", "px", "py", "pz", F.col("mass").cast("double").alias("mass"),
                    *[F.col(f"v{a}").cast("double").alias(f"v{a}") for a in "xyz"],
                    F.col("rel_px").alias("x"), F.col("rel_py").alias("y"), F.col("rel_pz").alias("z"))


@register("window_mass_sum", _WIN_MASS_SQL)
def window_mass_sum(spark: SparkSession, d: str) -> DataFrame:
    """Subhalo mass on every row (window total, computed as agg + join back)."""
    r = _win_rows(spark, d)
    out = group_totals(r, ["subhalo_id"], {"mass_sum": F.sum("mass")},
                       salt_cols=["id", "px", "py", "pz"], tag="win-mass")
    return out.select("subhalo_id", "id", "px", "py", "pz", "mass", "mass_sum")


@register("window_mean_velocity", _WIN_VEL_SQL)
def window_mean_velocity(spark: SparkSession, d: str) -> DataFrame:
    """Mass-weighted mean velocity of the subhalo on every row."""
    r = _win_rows(spark, d)
    totals = {"_M": F.sum("mass"), **{f"_mv{a}": F.sum(F.col("mass") * F.col(f"v{a}")) for a in "xyz"}}
    out = group_totals(r, ["subhalo_id"], totals, salt_cols=["id", "px", "py", "pz"], tag="win-vel")
    return out.select("subhalo_id", "id", "px", "py", "pz",
                      *[F.try_divide(F.col(f"_mv{a}"), F.col("_M")).alias(f"v{a}_avg") for a in "xyz"])


@register("window_angular_momentum", _WIN_J_SQL)
def window_angular_momentum(spark: SparkSession, d: str) -> DataFrame:
    """Subhalo angular momentum J = sum m (x cross (v - vbar)) on every row."""
    r = _win_rows(spark, d)
    totals = {"_M": F.sum("mass"), **{f"_mv{a}": F.sum(F.col("mass") * F.col(f"v{a}")) for a in "xyz"}}
    r1 = group_totals(r, ["subhalo_id"], totals, salt_cols=["id", "px", "py", "pz"], tag="win-vbar")
    u = tuple(F.col(f"v{a}") - F.try_divide(F.col(f"_mv{a}"), F.col("_M")) for a in "xyz")
    j = cross((F.col("x"), F.col("y"), F.col("z")), u)
    r1 = r1.select("subhalo_id", "id", "px", "py", "pz", *[(c * F.col("mass")).alias(f"_j{a}")
                                                            for c, a in zip(j, "xyz")])
    r2 = group_totals(r1, ["subhalo_id"], {f"j_tot_{a}": F.sum(f"_j{a}") for a in "xyz"},
                      salt_cols=["id", "px", "py", "pz"], tag="win-J")
    return r2.select("subhalo_id", "id", "px", "py", "pz",
                     *[quantize(F.col(f"j_tot_{a}"), O.MEASURE_DECIMALS).alias(f"j_tot_{a}") for a in "xyz"])


# ------------------------------------------------------------------ inspection

@register("distinct_subhalos",
          f"SELECT COUNT(*) AS n_distinct FROM (SELECT DISTINCT subhalo_id FROM ({O.pairs_sql('star')}) p) d")
def distinct_subhalos(spark: SparkSession, d: str) -> DataFrame:
    return stats.distinct_count(jobs.pair_table(spark, d, "star"), "subhalo_id")


_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", COUNT(*) AS n_rows FROM ({sql}) t" for name, sql in (
        ("subhalos", O.subhalos_sql()), ("star_particles", O.particles_sql("star")),
        ("dm_particles", O.particles_sql("dm")), ("star_pairs", O.pairs_sql("star")),
        ("dm_pairs", O.pairs_sql("dm"))))


@register("row_counts", _COUNTS_SQL)
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.row_counts({
        "subhalos": fx.subhalo_catalog(spark, d), "star_particles": fx.star_particles(spark, d),
        "dm_particles": fx.dm_particles(spark, d), "star_pairs": jobs.pair_table(spark, d, "star"),
        "dm_pairs": jobs.pair_table(spark, d, "dm")})


_SUMMARY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, "
    f"{O.qround(f'AVG(CAST({c} AS DOUBLE))', O.MEASURE_DECIMALS)} AS mean, "
    f"{O.qround(f'STDDEV_SAMP(CAST({c} AS DOUBLE))', O.MEASURE_DECIMALS)} AS stddev, "
    f"MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max FROM ({O.particles_sql('star')}) p"
    for c in STAR_COLS)


@register("summary_stats", _SUMMARY_SQL)
def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    """count / mean / stddev / min / max of every star-particle column."""
    s = stats.summary(fx.star_particles(spark, d), STAR_COLS)
    return s.select("column", "count", quantize(F.col("mean"), O.MEASURE_DECIMALS).alias("mean"),
                    quantize(F.col("stddev"), O.MEASURE_DECIMALS).alias("stddev"), "min", "max")


def _rh_kin(spark: SparkSession, d: str) -> DataFrame:
    # the notebook's per-subhalo aperture: StarHalfRad x h (h = 0.6774), star particles
    return ap.column_kinematics(jobs.pair_table(spark, d, "star"), "StarHalfRad", "star", scale=1, h=H_JOIN, **NOISE)


_RH_KIN_SQL = O.kinematics_sql(O.scaled_rows_sql("star", 1, h=H_JOIN), ["subhalo_id"], decimals=None)


@register("histogram_vrot", O.hist_sql(MEASURES[6], _RH_KIN_SQL))
def histogram_vrot(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(_rh_kin(spark, d), MEASURES[6])


@register("histogram_sigma2", O.hist_sql(MEASURES[4], _RH_KIN_SQL))
def histogram_sigma2(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(_rh_kin(spark, d), MEASURES[4])


@register("histogram_radius", O.hist_sql("StarHalfRad", O.subhalos_sql(), 4, 2.0, 10.0))
def histogram_radius(spark: SparkSession, d: str) -> DataFrame:
    """Radii of 2 to 10 in four bins: the largest falls on the closed end of the last."""
    return stats.histogram(fx.subhalo_catalog(spark, d), "StarHalfRad", 4, 2.0, 10.0)


@register("head_n", f"SELECT * FROM ({O.pairs_sql('star')}) p ORDER BY subhalo_id, sq_dist_subhalo2ptl, "
                    + ", ".join(c for c in STAR_COLS) + " LIMIT 4")
def head_n(spark: SparkSession, d: str) -> DataFrame:
    """The 4 pairs closest to the lowest subhalo ids (a top-n report)."""
    return stats.head(jobs.pair_table(spark, d, "star"), 4, ["subhalo_id", "sq_dist_subhalo2ptl", *STAR_COLS])

