"""Operators for preparing training text.

Functions that run in Python workers are shipped by value, so executors need
only the listed third-party packages, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
