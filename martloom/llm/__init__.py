"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Code that runs on executors travels with the task, so they needn't have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
