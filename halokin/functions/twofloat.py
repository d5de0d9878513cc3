"""Error-free double arithmetic as SQL expressions: a value as an unevaluated sum of doubles.

Sums of terms that nearly cancel lose what a double can't hold. These helpers keep it: a product
or sum gives its rounded value and its error, and a term is cut at a fixed binary place, so that the upper
parts of any number of rows add up without rounding, in any order, as long as their total stays below
2**53 places. What lies below, and the errors, are smaller by that factor and summed beside them.

Only +, - and * of IEEE doubles are used, so everything stays in generated code. Arguments are repeated in the
expressions: pass column names, and name a step's results (``project``) before the next one uses them.
"""

from __future__ import annotations

from typing import Sequence, Tuple

from pyspark.sql import DataFrame

Pair = Tuple[str, str]
#: Binary orders by which the sum of a group may exceed the scale that its terms are cut by.
HEADROOM = 30
_SPLITTER = "134217729D"  # 2**27 + 1


def two_sum(a: str, b: str) -> Pair:
    """(fl(a + b), its error)."""
    s = f"({a} + {b})"
    t = f"({s} - {a})"
    return s, f"(({a} - ({s} - {t})) + ({b} - {t}))"


def two_difference(a: str, b: str) -> Pair:
    """(fl(a - b), its error)."""
    s = f"({a} - {b})"
    t = f"({s} - {a})"
    return s, f"(({a} - ({s} - {t})) - ({b} + {t}))"


def halves(a: str) -> Pair:
    """Two parts of at most 26 bits each."""
    upper = f"({a} * {_SPLITTER} - ({a} * {_SPLITTER} - {a}))"
    return upper, f"({a} - {upper})"


def two_product(a: str, b: str) -> Pair:
    """(fl(a * b), its error)."""
    p = f"({a} * {b})"
    (ah, al), (bh, bl) = halves(a), halves(b)
    return p, f"((({ah} * {bh} - {p}) + {ah} * {bl} + {al} * {bh}) + {al} * {bl})"


def at_place(term: str, scale: str) -> Pair:
    """A term cut at a place ``2**(HEADROOM - 52)`` times ``scale``, without error: (upper part, rest)."""
    c = f"({scale} * {2.0 ** HEADROOM!r}D)"
    upper = f"(({term} + {c}) - {c})"
    return upper, f"({term} - {upper})"


def project(df: DataFrame, columns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """A projection of its own, so that later steps refer to values instead of repeating their expressions."""
    return df.selectExpr(*[f"`{c}`" for c in keep], *[f"{e} AS {n}" for n, e in columns.items()])
