"""Operators of a training-data pipeline over text tables; nothing else in the package imports it.

Functions that Spark runs in Python workers are sent by value, so workers need the libraries that
they use but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
