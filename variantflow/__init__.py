"""Variant fan-out, batch inference, keyed state and multi-head scoring on Spark."""

from pyspark import cloudpickle as _cloudpickle

import sys as _sys

# Python workers receive this package's functions inside the pickled plan, so
# nothing has to be installed on the executors.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
