"""Operators for preparing training text: deduplication, classifiers, filters, mixing, extraction and scans."""

import sys

from pyspark import cloudpickle

# Functions that run in Spark's tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
