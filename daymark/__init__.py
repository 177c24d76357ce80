"""Daily-demand and risk-scoring analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors travel with their code, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
