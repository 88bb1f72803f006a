"""Record-flow data work on Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors
# need no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
