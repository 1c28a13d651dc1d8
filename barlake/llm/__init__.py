"""Operators for preparing training text: search, filters, deduplication, scoring, packing."""

import sys

from pyspark import cloudpickle

# Executors then need no copy of this package to run the functions that tasks carry.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
