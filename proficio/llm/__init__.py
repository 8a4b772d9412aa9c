"""Operators for training-data pipelines: filtering, language ID, dedup, formatting, tokens, packing."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so they need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
