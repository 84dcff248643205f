"""Spark-native data work around chat language models.

Every operator is a function from DataFrame to DataFrame, or from Column to
Column.  Nothing here starts a job on its own unless its docstring says so.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the query, so that
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
