"""Operators of a training-data pipeline: scoring, de-duplication, decontamination, extraction, filters, output."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
