"""Anomaly analytics for multi-device sensor series, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Arrow functions below travel to the executors by value, so a cluster needs no
# copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
