"""Helper columns that can't clash with a caller's."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame

from . import bloom

#: Columns that the filter adds to rows for a while.
BLOOM = ("__block", "__maybe", *bloom.WORDS)


def set_aside(*helpers: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """For a function of a frame that adds the ``helpers`` for a while: columns of the frame with one of these names have another
    one meanwhile, also where arguments name them, and get their own back in the result."""
    taken = {h.lower() for h in helpers}

    def wrap(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(function)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            moved = {c: f"{c}__of_caller" for c in docs.columns if c.lower() in taken}
            if not moved:
                return function(docs, *args, **kwargs)
            kwargs = {k: moved.get(v, v) if isinstance(v, str) else v for k, v in kwargs.items()}
            return function(docs.withColumnsRenamed(moved), *args, **kwargs).withColumnsRenamed({v: k for k, v in moved.items()})

        return run

    return wrap
