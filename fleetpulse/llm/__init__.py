"""Operators for preparing text and vectors for model training."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
