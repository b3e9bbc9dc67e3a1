"""Operators of a training-data pipeline, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors as code; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
