"""Training-data operators: quality, packing, mixing, deduplication, sharding, filters, PII.

Functions that run in tasks are pickled by value, so executors need numpy,
pandas and pyarrow (and ``tokenizers`` for packing) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
