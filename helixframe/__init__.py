"""Genomic copy-number analysis on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Spark's Python workers carry their code with them, so that executors need
# no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
