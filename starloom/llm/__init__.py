"""Training-data operators on Spark.

Functions that run inside tasks are pickled by value, so executors need the
third-party libraries but no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
