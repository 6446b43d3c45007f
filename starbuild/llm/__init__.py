"""Operators of a training-data pipeline.  Nothing else in the library imports this package.

Functions that run in Python workers travel by value, so executors need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
