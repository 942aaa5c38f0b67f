"""Operators of a training-data pipeline over a table of documents.

Functions that run in tasks travel to the executors by value, so the package
need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
