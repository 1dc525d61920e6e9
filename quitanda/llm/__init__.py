"""Operators for preparing training data, and their registered queries.

Functions of this package travel to the Python workers by value, so that executors need no
copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
