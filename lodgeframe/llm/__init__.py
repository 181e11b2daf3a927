"""Training-data operators: quality, rules, near-duplicates, packing, PII, LM scores,
licences, mixing, line deduplication, nearest vectors, manifests, near-duplicate vectors
and phrases. Nothing else in the library
imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
