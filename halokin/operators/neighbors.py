"""Periodic spatial neighbour join: every (particle, subhalo) pair closer than
the join radius under minimum-image distance in a periodic box.

Plan (Spark-first form of a grid pre-filter):

1. Each subhalo is registered in every grid cell that its sphere (radius plus a
   small rounding pad) overlaps — at most 27 cells when the cell is at least the
   radius. This small table is exploded once.
2. Particles get their own cell; the join is an equi-join on ``(cx, cy, cz)``.
   With a registration table of checked size it is a ``BroadcastHashJoin``:
   the particle side is streamed and never shuffled, so a dense cell costs
   nothing extra. Beyond the size limit the registrations are split into
   x-slab ranges that each fit the limit ("chunked"): every chunk is a
   broadcast join of the particles of its slab range only, selected by a
   ``px`` range that Parquet can prune on row-group statistics, so a
   snapshot clustered by x (``jobs.write_snapshot``) is read about once (a chunk opens only the files
   whose ``px`` range meets its own) and never shuffled, whatever the number of chunks: beyond ``max_chunks`` they are worked off in
   waves. A slab beyond the limit is cut into up to ``MAX_PARTS`` parts by cell. Only the particles of
   still fuller slabs are shuffled on the
   cell key. Cells with more particles than a task should have are found by a
   count first; only they are salted, over as many tasks as their size asks for.
3. The exact test ``|min_image(p - s)|^2 < radius^2`` runs after the join, in
   the same codegen stage. Pairs are many-to-many: one particle can appear
   under several subhalos.

Output: all particle columns, ``ix, iy, iz`` (unwrapped cells, as the original
pair table), the renamed subhalo columns, ``subhalo_ix..iz``, the displacement
``rel_px..pz`` and ``sq_dist_subhalo2ptl``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BOX_SIZE, GRID_CELLS, H_JOIN, JOIN_RADIUS_KPC
from ..functions import grid
from ..functions.grid import cell_size
from ..functions.vectors import min_image, sq
from ..schemas import SUBHALO_RENAMES
from ..session import materialize, scratch_path
from .joinback import DEFAULT_BROADCAST_MAX_ROWS, broadcastable_rows, hot_groups

DEFAULT_MAX_CHUNKS = 64
#: Bytes of registrations in one broadcast: every task of the join holds their hash table, of over twice as many bytes, beside its own rows.
REGISTRATION_BYTES = 64 * 2**20
#: The same for all broadcasts of one query: Spark makes them side by side, and the driver holds the rows, the hash table and the blocks of each.
QUERY_BYTES = 64 * 2**20
#: Parts that an x-slab's registrations are cut into at most; its particles are read once for each.
MAX_PARTS = 4


def rename_subhalos(catalog: DataFrame) -> DataFrame:
    """Prefix the catalogue columns (``px -> subhalo_px``, ``sub_id -> subhalo_id``)."""
    present = {k: v for k, v in SUBHALO_RENAMES.items() if k in catalog.columns}
    return catalog.withColumnsRenamed(present) if present else catalog


def subhalo_registrations(subhalos: DataFrame, radius: float, box: float = BOX_SIZE,
                          n_cells: int = GRID_CELLS) -> DataFrame:
    """One row per (cell, subhalo) for every cell the subhalo's sphere overlaps.

    The pad covers float32 rounding of the coordinates (half an ulp at the box
    scale is box * 2**-25); a wider candidate set is harmless because the exact
    distance test follows.
    """
    reach = radius + box * 2.0 ** -20
    subs = rename_subhalos(subhalos)
    subs = subs.withColumns({
        "subhalo_ix": grid.raw_cell(F.col("subhalo_px"), box, n_cells),
        "subhalo_iy": grid.raw_cell(F.col("subhalo_py"), box, n_cells),
        "subhalo_iz": grid.raw_cell(F.col("subhalo_pz"), box, n_cells),
    })
    return (
        subs.withColumn("cx", F.explode(grid.overlap_cells(F.col("subhalo_px"), reach, box, n_cells)))
        .withColumn("cy", F.explode(grid.overlap_cells(F.col("subhalo_py"), reach, box, n_cells)))
        .withColumn("cz", F.explode(grid.overlap_cells(F.col("subhalo_pz"), reach, box, n_cells)))
    )


def particle_cells(particles: DataFrame, box: float = BOX_SIZE, n_cells: int = GRID_CELLS) -> DataFrame:
    """Particles with their unwrapped cell ``ix, iy, iz`` and wrapped join key ``cx, cy, cz``."""
    p = particles.withColumns({
        "ix": grid.raw_cell(F.col("px"), box, n_cells),
        "iy": grid.raw_cell(F.col("py"), box, n_cells),
        "iz": grid.raw_cell(F.col("pz"), box, n_cells),
    })
    return p.withColumns({
        "cx": F.pmod(F.col("ix"), F.lit(n_cells)),
        "cy": F.pmod(F.col("iy"), F.lit(n_cells)),
        "cz": F.pmod(F.col("iz"), F.lit(n_cells)),
    })


def _slab_filter(k0: int, k1: int, box: float, n_cells: int) -> Column:
    """Rows whose wrapped x cell is in ``[k0, k1)``: an exact test on the cell,
    and a ``px`` range superset of it that the scan can push down."""
    size = cell_size(box, n_cells)
    px = F.col("px")
    # out-of-box positions wrap by the modulo; they are rare and always admitted,
    # so the superset never depends on how far outside the box they lie
    superset = ((px >= F.lit((k0 - 1) * size)) & (px < F.lit((k1 + 1) * size))) | (px < 0) | (px >= F.lit(box))
    return superset & (F.col("cx") >= k0) & (F.col("cx") < k1)


@dataclass(frozen=True)
class Chunk:
    """Registrations of the x-slabs ``[k0, k1)``: all, or one ``part`` of ``parts`` by a hash of the cell."""
    k0: int
    k1: int
    part: int = 0
    parts: int = 1

    def _own(self) -> Column:
        own = (F.col("cx") >= self.k0) & (F.col("cx") < self.k1)
        return own & (F.pmod(F.xxhash64("cx", "cy", "cz"), F.lit(self.parts)) == self.part) if self.parts > 1 else own

    def registrations(self, regs: DataFrame) -> DataFrame:
        return regs.filter(self._own())

    def particles(self, parts: DataFrame, box: float, n_cells: int) -> DataFrame:
        return parts.filter(_slab_filter(self.k0, self.k1, box, n_cells) & self._own())


def plan_chunks(regs: DataFrame, limit: int) -> tuple[list[Chunk], list[int]]:
    """(chunks of at most ``limit`` registrations, x-slabs that are too full for chunks).

    Slabs next to each other are put together. A slab of more registrations is cut into parts by cell, of which
    each reads the slab's particles again; with more than ``MAX_PARTS`` parts, or if one cell is too full, the
    slab is not chunked. What reaches the driver is a count for each slab that has registrations, and for each part."""
    counts = sorted((r["cx"], r["n"]) for r in regs.groupBy("cx").agg(F.count(F.lit(1)).alias("n")).collect())
    parts = {cx: math.ceil(1.25 * n / limit) for cx, n in counts if n > limit}
    full = {cx for cx, k in parts.items() if k > MAX_PARTS}
    cut = {cx: k for cx, k in parts.items() if cx not in full}
    if cut:
        number = F.lit(1)
        for k in sorted(set(cut.values())):
            number = F.when(F.col("cx").isin([cx for cx, own in cut.items() if own == k]), F.lit(k)).otherwise(number)
        each = regs.where(F.col("cx").isin(list(cut))).groupBy("cx", F.pmod(F.xxhash64("cx", "cy", "cz"), number).alias("part"))
        full |= {r["cx"] for r in each.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("cx").distinct().collect()}
    chunks: list[Chunk] = []
    start, end, total = None, 0, 0
    for cx, n in [*counts, (None, limit + 1)]:
        if start is not None and (n > limit or total + n > limit):
            chunks.append(Chunk(start, end))
            start = None
        if n > limit:
            if cx in cut and cx not in full:
                chunks += [Chunk(cx, cx + 1, p, cut[cx]) for p in range(cut[cx])]
            continue
        start, total = (cx, n) if start is None else (start, total + n)
        end = cx + 1
    return chunks, sorted(full)


def slab_chunks(regs: DataFrame, limit: int, max_chunks: int) -> list[tuple[int, int]] | None:
    """The slab ranges of ``plan_chunks`` if whole slabs make at most ``max_chunks`` chunks, else None."""
    chunks, full = plan_chunks(regs, limit)
    return None if full or len(chunks) > max_chunks or any(c.parts > 1 for c in chunks) else [(c.k0, c.k1) for c in chunks]


def file_ranges(particles: DataFrame) -> list[tuple[str, float, float]] | None:
    """(path, lowest, highest px) of every file that holds particles with a ``px``; None if the particles don't come from files of one table."""
    try:
        path = particles.metadataColumn("_metadata")["file_path"]
        each = particles.groupBy(path.alias("path")).agg(F.min("px").alias("lo"), F.max("px").alias("hi")).where(F.col("lo").isNotNull())
    except AnalysisException:
        return None
    return [(r["path"], r["lo"], r["hi"]) for r in each.collect()]


def _own_files(particles: DataFrame, files: list[tuple[str, float, float]] | None, chunk: Chunk, box: float, n_cells: int) -> DataFrame:
    """The particles of the files that a chunk's particles can be in, so that a chunk's tasks don't open the files of all others."""
    if files is None:
        return particles
    size = cell_size(box, n_cells)
    # as in _slab_filter, positions outside the box are always admitted (NaN is above all numbers)
    own = [path for path, lo, hi in files if lo < 0 or not hi < box or (hi >= (chunk.k0 - 1) * size and lo < (chunk.k1 + 1) * size)]
    return particles.where(particles.metadataColumn("_metadata")["file_path"].isin(own))


def _hot_cells(parts: DataFrame, keys: list[str], rows_per_task: int | None) -> DataFrame:
    """(cell, _salts): cells of more than ``rows_per_task`` particles and the tasks to spread them over."""
    sizes = materialize(parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "cell-sizes")
    return hot_groups(sizes, keys, rows_per_task)


def _shuffled(parts: DataFrame, regs: DataFrame, part_cols: list[str], salt_buckets: int | None, rows_per_task: int | None) -> DataFrame:
    """Both sides shuffled on the cell key, large cells salted."""
    keys = ["cx", "cy", "cz"]
    if salt_buckets:
        salts = F.lit(int(salt_buckets))
    else:
        hot = F.broadcast(_hot_cells(parts, keys, rows_per_task))
        parts, regs = parts.join(hot, keys, "left"), regs.join(hot, keys, "left")
        salts = F.coalesce(F.col("_salts"), F.lit(1))
    parts = parts.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in part_cols]), salts).cast("int")).drop("_salts")
    regs = regs.withColumn("_salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int")))).drop("_salts")
    return parts.join(regs, keys + ["_salt"], "inner")


def neighbour_join(particles: DataFrame, subhalos: DataFrame, **opts) -> DataFrame:
    """All (particle, subhalo) pairs with ``sq_dist < (radius_kpc*h)^2``; the options are those of ``neighbour_waves``.

    One wave is a lazy result. The pairs of more are written here, wave by wave; the result reads these."""
    waves = neighbour_waves(particles, subhalos, **opts)
    if len(waves) == 1:
        return waves[0]
    path = scratch_path(particles.sparkSession, "pairs-by-chunk")
    folders = [f"{path}/wave={k}" for k in range(len(waves))]
    for wave, folder in zip(waves, folders):
        wave.write.parquet(folder)
    return particles.sparkSession.read.parquet(*folders)


def neighbour_waves(particles: DataFrame, subhalos: DataFrame, *,
                    h: float = H_JOIN, radius_kpc: float = JOIN_RADIUS_KPC,
                    box: float = BOX_SIZE, n_cells: int = GRID_CELLS,
                    strict: bool = True,
                    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                    salt_buckets: int | None = None, rows_per_task: int | None = None,
                    max_chunks: int = DEFAULT_MAX_CHUNKS, clustered: bool = True,
                    strategy: str = "auto") -> list[DataFrame]:
    """Lazy tables that hold all pairs of ``neighbour_join`` together, to be worked off one after the other.

    ``strategy``: ``"auto"`` broadcasts the registrations when their exact count
    is at most ``broadcast_max_rows``, otherwise uses slab chunks of at most
    that size, in any number; only the particles of slabs that are too full for that
    are shuffled. ``"broadcast"``, ``"chunked"`` and
    ``"shuffle"`` (of all particles) force one of them. ``strict=False`` keeps pairs at exactly
    the radius (``<=``).

    A wave has up to ``max_chunks`` chunks, and no more than make ``QUERY_BYTES`` of registrations. ``clustered=False`` says that the particles are not stored in order of x: before more than
    ``max_chunks`` chunks they are written so (one range shuffle), instead of being scanned for each chunk.
    ``rows_per_task`` is the number of particles above which
    a cell is split where particles are shuffled (default: see ``joinback.hot_groups``);
    ``salt_buckets`` splits every cell in so many parts instead.
    """
    radius = radius_kpc * h
    sq_radius = radius * radius
    part_cols = particles.columns
    regs = subhalo_registrations(subhalos, radius, box, n_cells)
    sub_cols = [c for c in regs.columns if c not in ("cx", "cy", "cz")]
    parts = particle_cells(particles, box, n_cells)
    keys = ["cx", "cy", "cz"]

    broadcast_max_rows = broadcastable_rows(regs, broadcast_max_rows, REGISTRATION_BYTES)
    in_query = broadcastable_rows(regs, QUERY_BYTES, QUERY_BYTES)
    chunks: list[Chunk] = []
    full: list[int] = []
    if strategy in ("auto", "chunked"):
        # the catalogue may be one file, that is one task, and a subhalo is up to 27 rows
        spread = subhalo_registrations(subhalos.repartition(4 * subhalos.sparkSession.sparkContext.defaultParallelism), radius, box, n_cells)
        if strategy == "auto" and spread.count() <= broadcast_max_rows:
            strategy = "broadcast"
        else:
            # in order of the slabs, so that a chunk skips the pages of others
            regs = materialize(spread.sortWithinPartitions("cx"), "registrations")
            chunks, full = plan_chunks(regs, broadcast_max_rows)
            # without registrations there is nothing to cut: an empty broadcast join
            strategy = "chunked" if chunks or full else "broadcast"

    def finished(joined: DataFrame) -> DataFrame:
        return _pairs(joined, part_cols, sub_cols, box, sq_radius, strict)

    if strategy == "broadcast":
        return [finished(parts.join(F.broadcast(regs), keys, "inner"))]
    if strategy == "shuffle":
        return [finished(_shuffled(parts, regs, part_cols, salt_buckets, rows_per_task))]
    if strategy != "chunked":
        raise ValueError(f"unknown strategy {strategy!r}")
    if len(chunks) > max_chunks and not clustered:
        ordered = particles.repartitionByRange("px").sortWithinPartitions("px")
        particles = materialize(ordered, "clustered")
        parts = particle_cells(particles, box, n_cells)
    files = file_ranges(particles) if len(chunks) > 1 else None
    pieces = [c.particles(particle_cells(_own_files(particles, files, c, box, n_cells), box, n_cells), box, n_cells)
              .join(F.broadcast(c.registrations(regs)), keys, "inner") for c in chunks]
    if full:
        own = F.col("cx").isin(full)
        near = _slab_filter(min(full), max(full) + 1, box, n_cells)
        pieces.append(_shuffled(parts.filter(near & own), regs.filter(own), part_cols, salt_buckets, rows_per_task))
    most = max(1, min(max_chunks, in_query // max(1, broadcast_max_rows)))
    if len(chunks) <= most:
        return [finished(reduce(DataFrame.unionByName, pieces))]
    return [finished(reduce(DataFrame.unionByName, pieces[k: k + most])) for k in range(0, len(pieces), most)]


def _pairs(joined: DataFrame, part_cols: list[str], sub_cols: list[str], box: float, sq_radius: float, strict: bool) -> DataFrame:
    """The displacement of every candidate, and the exact test."""
    rel = {
        "rel_px": min_image(F.col("px"), F.col("subhalo_px"), box),
        "rel_py": min_image(F.col("py"), F.col("subhalo_py"), box),
        "rel_pz": min_image(F.col("pz"), F.col("subhalo_pz"), box),
    }
    out = joined.select(*part_cols, "ix", "iy", "iz", *sub_cols, *[c.alias(n) for n, c in rel.items()])
    out = out.withColumn("sq_dist_subhalo2ptl",
                         sq(F.col("rel_px")) + sq(F.col("rel_py")) + sq(F.col("rel_pz")))
    d2 = F.col("sq_dist_subhalo2ptl")
    return out.filter(d2 < F.lit(sq_radius) if strict else d2 <= F.lit(sq_radius))
