"""Retrieval over document tables and guarded questions over relational tables, as Spark DataFrame operators."""
import sys

from pyspark import cloudpickle

# Send the functions that run in tasks with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
