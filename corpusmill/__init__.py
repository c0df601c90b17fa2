"""Corpus mining and feature engineering on PySpark DataFrames."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are shipped by value: the executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
