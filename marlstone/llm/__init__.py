"""Operators for preparing training text: dedup, scans, scoring, mixing, packing."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# functions run in tasks travel with their code, so executors need no install
register_pickle_by_value(sys.modules[__name__])
