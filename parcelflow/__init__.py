"""parcelflow: delivery-order analytics as plain Spark DataFrame and Structured Streaming jobs."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the tasks; executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
