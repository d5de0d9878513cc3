"""Explicit schemas of the particle, catalogue and result tables (all nullable)."""

from __future__ import annotations

from pyspark.sql import types as T

F32, F64, I32, I64 = T.FloatType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


POS_VEL = [("px", F32), ("py", F32), ("pz", F32), ("vx", F32), ("vy", F32), ("vz", F32)]

STAR_PARTICLES = _struct(*POS_VEL, ("mass", F32), ("id", I64), ("formation_time", F32))
DM_PARTICLES = _struct(*POS_VEL, ("id", I64))
SUBHALOS = _struct(*POS_VEL, ("sub_id", I32), ("StarHalfRad", F32))
RADIUS_SIDE_TABLE = _struct(("subhalo_id", I32), ("StarHalfRad", F32))

# Column names as they appear in the raw CSV / text files (pandas-style headers),
# mapped onto the typed Parquet names.
STAR_CSV_COLUMNS = {"px": "px", "py": "py", "pz": "pz", "vx": "vx", "vy": "vy", "vz": "vz",
                    "mass": "mass", "ID": "id", "Formation_time": "formation_time"}
DM_CSV_COLUMNS = {"px": "px", "py": "py", "pz": "pz", "vx": "vx", "vy": "vy", "vz": "vz", "ID": "id"}
SUBHALO_TXT_COLUMNS = {"px": "px", "py": "py", "pz": "pz", "vx": "vx", "vy": "vy", "vz": "vz",
                       "SubfindID": "sub_id", "StarHalfRad": "StarHalfRad"}

# Renames applied to the catalogue before the neighbour join.
SUBHALO_RENAMES = {"px": "subhalo_px", "py": "subhalo_py", "pz": "subhalo_pz",
                   "vx": "subhalo_vx", "vy": "subhalo_vy", "vz": "subhalo_vz",
                   "StarHalfMass": "subhalo_StarHalfMass", "sub_id": "subhalo_id"}

# Kinematics result columns, in output order.
MEASURES = (
    "total_kinetic_energy",
    "mass_weighted_velocity_dispersion_x",
    "mass_weighted_velocity_dispersion_y",
    "mass_weighted_velocity_dispersion_z",
    "mass_weighted_velocity_dispersion",
    "rotation_kinetic_energy",
    "mass_weighted_rotation_velocity",
    "mass_weighted_velocity_dispersion_r",
    "mass_weighted_velocity_dispersion_theta",
    "mass_weighted_velocity_dispersion_phi",
    "mass_weighted_velocity_dispersion_phi_no_rotation",
    "mass_weighted_velocity_dispersion_no_rotation",
    "mass_weighted_velocity_dispersion_x_no_rotation",
    "mass_weighted_velocity_dispersion_y_no_rotation",
    "mass_weighted_velocity_dispersion_z_no_rotation",
)
UNIT_J = ("unitJ_x", "unitJ_y", "unitJ_z")

# Short names of the exported catalogues.
CATALOG_3D = (
    ("mass_weighted_velocity_dispersion", "sigma2"),
    ("mass_weighted_rotation_velocity", "Vrot"),
    ("total_kinetic_energy", "Ktot"),
    ("rotation_kinetic_energy", "Krot"),
    ("mass_weighted_velocity_dispersion_no_rotation", "sigma2_noRot"),
    ("unitJ_x", "unitJ_x"),
    ("unitJ_y", "unitJ_y"),
    ("unitJ_z", "unitJ_z"),
)
CATALOG_2D = (
    ("mass_weighted_velocity_dispersion_x", "sigma2_x"),
    ("mass_weighted_velocity_dispersion_y", "sigma2_y"),
    ("mass_weighted_velocity_dispersion_z", "sigma2_z"),
    ("mass_weighted_velocity_dispersion_r", "sigma2_r"),
    ("mass_weighted_velocity_dispersion_theta", "sigma2_theta"),
    ("mass_weighted_velocity_dispersion_phi", "sigma2_phi"),
    ("mass_weighted_velocity_dispersion_x_no_rotation", "sigma2_x_noRot"),
    ("mass_weighted_velocity_dispersion_y_no_rotation", "sigma2_y_noRot"),
    ("mass_weighted_velocity_dispersion_z_no_rotation", "sigma2_z_noRot"),
    # rotation has no radial part (phi-hat is perpendicular to r-hat), so the
    # radial no-rotation dispersion is the radial dispersion itself
    ("mass_weighted_velocity_dispersion_r", "sigma2_r_noRot"),
    ("mass_weighted_velocity_dispersion_phi_no_rotation", "sigma2_phi_noRot"),
)
