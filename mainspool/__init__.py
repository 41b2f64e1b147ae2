"""Mainframe record data on Spark: scan, decode, filter, route, split and write."""

from pyspark import cloudpickle as _cloudpickle

import sys as _sys

# Ship the few worker-side functions with the tasks, so executors need no install.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
