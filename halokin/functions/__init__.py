"""Column-expression helpers: vector algebra and the spatial grid."""

from . import grid, vectors  # noqa: F401
