"""Operators for building training data from documents, pages and vectors.

Nothing else in the library imports this package.  Its functions travel to Python workers by
value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
