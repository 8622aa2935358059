"""Social-text analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of the library travel with the tasks, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
