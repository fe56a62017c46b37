"""Operators for preparing training text at scale.

Functions that run on executors travel by value, so the executors need the installed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
