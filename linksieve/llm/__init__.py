"""Operators for large text corpora; the rest of the library does without them.

Code of this subpackage travels to the executors by value, so they need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
