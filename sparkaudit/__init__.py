"""Spark-native exploration, validation and audit of tabular analyses."""

import sys

from pyspark import cloudpickle

# functions used in tasks travel with the job, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
