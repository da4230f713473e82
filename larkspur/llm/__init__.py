"""Training-data operators: language id, URL rules, near-duplicate joins, mixing, sharding, archives, PII,
decontamination and substring de-duplication.  Nothing outside this package imports it."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the executors by value, so it need not be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
