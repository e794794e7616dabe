"""Operators of a training-data pipeline: one module each, queries and SQL beside them.

Functions and classes of this subpackage travel to the executors by value, so a job needs
no copy of the package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
