"""tesserae: a Spark-first engine that turns web pages into checked question-answer data and packed long-context samples."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions that run on executors travel by value, so the workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
