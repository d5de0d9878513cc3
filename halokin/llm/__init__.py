"""Operators of a large-scale training-data pipeline, on Spark DataFrames.

One module per operator; ``queries`` registers them over the given tables. Nothing
else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
