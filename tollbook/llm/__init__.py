"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks receive these functions themselves, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
