"""Customer segmentation over event logs, as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

from segmentry.session import get_spark, materialize

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "materialize"]
