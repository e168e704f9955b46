"""cardwarden: preparing, scoring and monitoring card transactions on Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run inside Python workers travel with their tasks, so executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
