"""quizloom: build and grade multiple-choice question benchmarks on Spark."""

import sys

from pyspark import cloudpickle

# Tasks receive the package's functions by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
