"""Operators for training data: formatting, deduplication, packing, mixing, quality and personal data.

Nothing else in the library imports this subpackage. Its functions run in Python workers, which
need no copy of the package: the subpackage is pickled by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
