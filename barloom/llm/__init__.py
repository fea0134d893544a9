"""Operators for building training corpora out of the ``documents`` tables.

Task functions are shipped to the executors by value, so the executors need
the third-party libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
