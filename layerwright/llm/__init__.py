"""Operators for preparing training text: near and exact duplicates, contamination, language, packing, scoring.

Nothing outside this package imports it.  Task functions travel to the executors by value, so a worker needs
the public libraries only, not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
