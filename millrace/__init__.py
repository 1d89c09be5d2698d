"""Event-driven order processing on Spark: fraud, enrichment, payments, stock, change data."""

import sys

from pyspark import cloudpickle

# Python functions go to executors whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
