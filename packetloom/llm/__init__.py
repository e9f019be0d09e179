"""Corpus operators; nothing else in the library imports this package.

Their functions are shipped to the executors by value, which need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
