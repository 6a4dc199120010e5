"""Operators for training-data pipelines over documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so that those need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
