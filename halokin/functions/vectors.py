"""3-vector algebra on triples of Columns.

Vectors stay as three scalar columns (``_x/_y/_z``) so every expression stays
inside whole-stage codegen; these helpers only build Column expressions.
Divisions use ``try_divide`` so that a zero norm gives NULL instead of raising
DIVIDE_BY_ZERO under ANSI mode (the row is then skipped by ``sum``).
"""

from __future__ import annotations

from typing import Sequence, Tuple, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = Tuple[Column, Column, Column]
ColLike = Union[Column, str, float, int]


def _c(x: ColLike) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def vec(names: Union[str, Sequence[str]], cast: str | None = None) -> Vec:
    """Vector from a prefix (``"rel_p"`` -> rel_px, rel_py, rel_pz) or three names."""
    if isinstance(names, str):
        names = [f"{names}x", f"{names}y", f"{names}z"]
    cols = [F.col(n) for n in names]
    if cast:
        cols = [c.cast(cast) for c in cols]
    return cols[0], cols[1], cols[2]


def add(a: Vec, b: Vec) -> Vec:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def sub(a: Vec, b: Vec) -> Vec:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def scale(a: Vec, s: ColLike) -> Vec:
    s = _c(s)
    return a[0] * s, a[1] * s, a[2] * s


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return (
        a[1] * b[2] - a[2] * b[1],
        a[2] * b[0] - a[0] * b[2],
        a[0] * b[1] - a[1] * b[0],
    )


def sq(x: Column) -> Column:
    """Square as a product (exact rounding, cheaper than pow)."""
    return x * x


def norm2(a: Vec) -> Column:
    return sq(a[0]) + sq(a[1]) + sq(a[2])


def norm(a: Vec) -> Column:
    return F.sqrt(norm2(a))


def safe_div(a: Column, b: ColLike) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI-safe)."""
    return F.try_divide(a, _c(b))


def divide(a: Vec, s: ColLike) -> Vec:
    s = _c(s)
    return safe_div(a[0], s), safe_div(a[1], s), safe_div(a[2], s)


def unit(a: Vec, length: Column | None = None) -> Vec:
    """a / |a|; NULL components when |a| = 0."""
    return divide(a, norm(a) if length is None else length)


def min_image(p: Column, q: Column, box: float) -> Column:
    """Minimum-image displacement p - q in a periodic box, in [-box/2, box/2).

    ``p - q`` is evaluated in the input type first (float - float stays float),
    then shifted and wrapped in double, as in the original pipeline.
    """
    half = box / 2.0
    return F.pmod(p - q + F.lit(half), F.lit(float(box))) - F.lit(half)


def named(prefix: str, a: Vec, suffixes: Sequence[str] = ("x", "y", "z")) -> list[Column]:
    """Alias the components of a vector as ``prefix + suffix``."""
    return [c.alias(f"{prefix}{s}") for c, s in zip(a, suffixes)]
