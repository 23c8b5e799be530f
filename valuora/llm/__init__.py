"""Training-data operators: filters, scores, near-duplicates, scans and packing.

Nothing else in the library imports this package. Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_<name>`` queries over the given tables.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
