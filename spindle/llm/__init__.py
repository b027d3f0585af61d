"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is present.

Functions that run in tasks are shipped by value, so executors need no copy of
this package (broadcast values are plain lists and arrays for the same reason).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
