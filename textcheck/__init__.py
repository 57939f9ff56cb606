"""Audits of labelled text tables and binary text classifiers as Spark jobs.

Functions that run in Python workers are pickled by value, so executors need not be able to
import the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
