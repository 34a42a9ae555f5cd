"""corpusblocks: from text corpora to training blocks, batches and scores, as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to executors inside the task, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
