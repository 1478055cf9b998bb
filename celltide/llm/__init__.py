"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions sent to tasks carry their code along: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
