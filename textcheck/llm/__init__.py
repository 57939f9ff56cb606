"""Operators for training-data pipelines, and their queries.

Nothing else in the package imports this one. Functions that run in Python workers
are pickled by value, so executors need not be able to import the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
