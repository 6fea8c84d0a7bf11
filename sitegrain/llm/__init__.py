"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# What runs in Python tasks travels with them; executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
