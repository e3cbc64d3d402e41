"""graphspark: retrieval over knowledge graphs as Spark DataFrame plans.

Every operator takes DataFrames (a table of questions, not one question)
and returns a DataFrame; nothing is collected except size-checked
broadcast sides and the closure's empty-frontier test.
"""

import sys as _sys

__version__ = "0.1.0"

# The Arrow kernels (mapInPandas functions) are defined in this package.
# Pickle them by value so executors run them without having the package
# installed or on their path.
from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
