"""Vehicle-telemetry analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions handed to grouped-map and stateful operators travel to the executors by value, so nothing has to be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
