"""Operators of a training-data pipeline; nothing outside this subpackage imports it.

Functions of this subpackage go to Python workers by value, so workers need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
