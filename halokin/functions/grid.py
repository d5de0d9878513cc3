"""Coarse spatial grid over the periodic box.

A particle and a subhalo can only be neighbours if their cells are close; the
grid turns the all-pairs distance test into an equi-join on the cell key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BOX_SIZE, GRID_CELLS


def cell_size(box: float = BOX_SIZE, n_cells: int = GRID_CELLS) -> float:
    return box / n_cells


def raw_cell(p: Column, box: float = BOX_SIZE, n_cells: int = GRID_CELLS) -> Column:
    """``floor(p / cell)`` as int, not wrapped (p = box gives n_cells)."""
    return F.floor(p / F.lit(cell_size(box, n_cells))).cast("int")


def wrapped_cell(p: Column, box: float = BOX_SIZE, n_cells: int = GRID_CELLS) -> Column:
    """Cell index wrapped into [0, n_cells): usable as an equi-join key."""
    return F.pmod(F.floor(p / F.lit(cell_size(box, n_cells))), F.lit(n_cells)).cast("int")


def periodic_adjacent(a: Column, b: Column, n_cells: int = GRID_CELLS, span: int = 1) -> Column:
    """Theta form of cell adjacency: ``least(|a-b|, n-|a-b|) <= span``."""
    d = F.abs(a - b)
    return F.least(d, F.lit(n_cells) - d) <= span


def overlap_cells(centre: Column, radius: float, box: float = BOX_SIZE,
                  n_cells: int = GRID_CELLS) -> Column:
    """Array of the wrapped cells that the interval [c - radius, c + radius] touches.

    ``radius`` should already include a small pad against float rounding of the
    exact distance test. Duplicates (when the interval covers the whole axis)
    are removed, so a subhalo is registered at most once per cell.
    """
    size = cell_size(box, n_cells)
    c = centre.cast("double")
    lo = F.floor((c - F.lit(radius)) / F.lit(size))
    hi = F.floor((c + F.lit(radius)) / F.lit(size))
    return F.array_distinct(
        F.transform(F.sequence(lo, hi), lambda k: F.pmod(k, F.lit(n_cells)).cast("int"))
    )


def max_cells_per_axis(radius: float, box: float = BOX_SIZE, n_cells: int = GRID_CELLS) -> int:
    """Upper bound of ``size(overlap_cells(...))`` on one axis."""
    return min(n_cells, int(math.floor(2.0 * radius / cell_size(box, n_cells))) + 2)


def morton_key(x: str, y: str, z: str, box: float = BOX_SIZE, bits: int = 20) -> Column:
    """The place of a position on a space-filling curve: the bits of its three cells, ``2**bits`` on an axis, taken in turn.

    Positions outside of the box wrap; NULL in any coordinate gives NULL."""
    def spread(c: str) -> Column:
        v = F.pmod(F.floor(F.col(c).cast("double") / F.lit(box / 2 ** bits)), F.lit(2 ** bits))
        # two zero bits behind each bit, by halves of the number: the fixed masks of 21-bit interleaving
        for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(x), 2).bitwiseOR(F.shiftleft(spread(y), 1)).bitwiseOR(spread(z))
