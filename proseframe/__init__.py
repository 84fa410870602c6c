"""Text-dataset preparation and evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so a cluster needs the
# package on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
