"""Operators for preparing large text collections, each a function on DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so clusters need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
