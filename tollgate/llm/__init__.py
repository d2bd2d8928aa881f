"""Operators for a training-data pipeline. Nothing outside this package imports it.

Python functions of these modules travel to the executors by value, so executors need
not have the package installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
