"""Spark-native preparation and modelling of large labelled tables."""
import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the job, so the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
