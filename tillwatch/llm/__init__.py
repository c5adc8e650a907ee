"""Operators that prepare training data: filters, classifiers, near-duplicates, archives, tokens, packing.

Nothing outside this subpackage imports it. Its functions travel to the workers by value, so a cluster
needs no copy of the package on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
