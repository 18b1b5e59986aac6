"""Catalogue analytics on PySpark: products, prices and stores as DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel inside the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
