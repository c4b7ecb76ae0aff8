"""Operators for preparing training text at scale, one module per operator.

Nothing else in the library imports this package.  Functions that run inside
Spark tasks are pickled by value, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
