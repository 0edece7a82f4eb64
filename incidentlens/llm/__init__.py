"""Training-data operators: tokenisation, extraction, scoring, search, deduplication, mixing, sharding.

Nothing else in the package imports this subpackage; ``queries.QUERIES`` is what the entry
module registers, when the subpackage is there.
"""

import sys

from pyspark import cloudpickle

# task functions travel with their code, so executors need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
