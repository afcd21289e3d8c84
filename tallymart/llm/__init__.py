"""Operators for preparing training text at scale."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the task, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
