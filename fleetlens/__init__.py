"""fleetlens: infrastructure-telemetry analytics written as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so that the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
