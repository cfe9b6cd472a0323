"""Operators for training-data pipelines; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks carry their code along, so executors need not have this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
