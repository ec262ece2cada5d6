"""Operators of a training-data pipeline: search, privacy, dedup, quality, mixing, tokens, safety.

Nothing else in the library imports this subpackage.  Its functions are shipped
to Python workers by value, so an executor needs no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
