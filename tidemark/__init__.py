"""Event-time analytics for user-behaviour logs, written as Spark DataFrame functions.

The functions and stream processors travel to Python workers by value, so executors need not
have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
