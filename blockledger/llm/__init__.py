"""Operators of a training-data pipeline, each one a Spark job of its own.

Functions of this subpackage travel to the tasks by value, so executors need
no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
