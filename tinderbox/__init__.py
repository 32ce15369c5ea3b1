"""Spark-native news-event lakehouse: feeds in, conflict-heat indicators out."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
