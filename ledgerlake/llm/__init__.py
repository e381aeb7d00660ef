"""Operators for preparing language-model training data: one module per operator, one for the queries."""

import sys

from pyspark import cloudpickle

# Helpers that run on the executors travel with the job; the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
