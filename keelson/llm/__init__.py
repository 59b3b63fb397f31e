"""Operators for building training data sets: cleaning, deduplication, decontamination,
classification, sharding, packing and formatting. Nothing else in the library imports this
subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
