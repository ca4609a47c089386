"""Operators for preparing training text at scale.

Functions of this subpackage that run inside tasks are sent by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
