"""Operators of a training-data pipeline: one module for each.

Functions of this subpackage that run in Python workers travel with the task by
value, so a worker needs no copy of the package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
