"""Operators for preparing language-model training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
