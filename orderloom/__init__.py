"""Order intake, reconciliation, sales analytics and forecasting on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors get the few Python helpers with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
