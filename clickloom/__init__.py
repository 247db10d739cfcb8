"""Retail clickstream analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Kernels travel inside the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
