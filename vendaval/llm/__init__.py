"""Operators for preparing training data: each module is one operator, see ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks as a whole, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
