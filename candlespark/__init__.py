"""Market trades and candles as plain Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame, so that operators compose with
``df.transform`` and Catalyst sees one plan from scan to sink.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions used inside tasks travel with the task, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
