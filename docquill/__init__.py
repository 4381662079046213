"""docquill: document collections and question-answering logs on Spark.

Every operator is a lazy function from DataFrames to a DataFrame.
"""

import sys

from pyspark import cloudpickle

# Python workers receive the package's functions by value, so that a cluster
# needs no separate installation of it on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
