"""Operators of a training-data pipeline. Their Python functions travel to the executors by value."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
