"""Operators on tables."""

import sys

from pyspark import cloudpickle

# What tasks run travels with its code, so executors do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
