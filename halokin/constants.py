"""Physical and layout constants of the particle-snapshot pipeline.

FIXED VALUES — these must equal the values of the original pipeline for
identical results; they are stated here once, in natural order:

    Hubble parameter for the neighbour join and the notebook kinematics: 0.6774
    Hubble parameter for the catalogue kinematics and the size cut:      0.7
    periodic box size (kpc/h):                                          205000
    grid cells per axis:                                                6000
    neighbour-join radius (kpc):                                        50
    dark-matter particle mass before dividing by h:                     0.00398342749867548
    fixed apertures of the catalogue sweep (kpc):                       1, 3, 5, 10, 20, 30
    fixed apertures of the notebook export (kpc):                       50, 30, 20, 10, 5, 3
    multiples of the stellar half-mass radius of the catalogue sweep:   1, 2, 3, 5
    catalogue size cut:  StarHalfRad * 2 * h > 0.1
    catalogue mass cut:  StarHalfMass / h > 0.01
    histogram: 99 equal bins on [0, 1000], last bin closed
"""

from __future__ import annotations

H_JOIN = 0.6774
H_CATALOG = 0.7
BOX_SIZE = 205000.0
GRID_CELLS = 6000
JOIN_RADIUS_KPC = 50.0
DM_MASS_RAW = 0.00398342749867548
FIXED_APERTURES = (1, 3, 5, 10, 20, 30)
NOTEBOOK_APERTURES = (50, 30, 20, 10, 5, 3)
HALF_RADIUS_SCALES = (1, 2, 3, 5)
SIZE_CUT = 0.1
MASS_CUT = 0.01
HIST_BINS = 99
HIST_RANGE = (0.0, 1000.0)


def dm_particle_mass(h: float = H_CATALOG) -> float:
    """Constant mass of one dark-matter particle (M_sun/h units of the catalogue)."""
    return DM_MASS_RAW / h


def join_radius(h: float = H_JOIN, radius_kpc: float = JOIN_RADIUS_KPC) -> float:
    """Neighbour-join radius in box units (kpc/h)."""
    return radius_kpc * h
