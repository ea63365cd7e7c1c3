"""pagequarry: Spark DataFrame operators for document corpora."""

import sys

from pyspark import cloudpickle

from pagequarry.config import JobConfig

# Functions of this package travel to the executors by value: no install or zip is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["JobConfig"]
