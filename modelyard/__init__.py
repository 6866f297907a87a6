"""Model-lifecycle analytics as Spark jobs: tables in, DataFrames out."""

import sys

from pyspark import cloudpickle

from modelyard.session import build_session

# Functions of this package travel to the executors by value, so nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
