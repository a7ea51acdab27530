"""Operators for preparing training data; nothing else in the package imports this.

Functions that run in tasks are sent by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
