"""Membership-change analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
