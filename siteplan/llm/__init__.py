"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the workers by value: these need no copy of the repository.
register_pickle_by_value(sys.modules[__name__])
