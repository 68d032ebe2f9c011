"""Operators of a training-data pipeline over ``documents``, ``pages``, ``conversations``.

Functions that run in Python workers travel by value with the job, so that executors
need no installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
