"""Operators of a training-data pipeline: deduplication, search, filters, encoding and archives."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
