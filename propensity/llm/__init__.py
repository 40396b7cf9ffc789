"""Operators for building training data: text, page and vector tables at corpus scale."""

import sys

from pyspark import cloudpickle

# Task functions travel with the plan: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
