"""Operators for training-data corpora: near copies, search, filters, packing, archives."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so that a job started from a
# plain checkout does not need the package installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
