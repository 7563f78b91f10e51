"""Operators for training-data pipelines; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the task, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
