"""Federated analytics as plain PySpark jobs."""
import sys

from pyspark import cloudpickle

# Functions and data sources travel to the workers by value, so that executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
