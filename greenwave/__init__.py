"""Adaptive traffic-signal analytics as plain Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors, and the
# helper process that plans stateful streams, need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
