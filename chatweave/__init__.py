"""Chat training-data preparation, session replay and batch inference on Spark."""

import sys

from pyspark import cloudpickle

# Workers get the package's functions by value, so nothing has to be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
