"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks carry the functions of this package with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
