"""Operators of the training-data pipeline.

One module per operator; :mod:`tidewater.llm.queries` registers one query for
each.  Nothing outside this package imports it.

Functions that run inside Python workers are pickled by value, so a cluster
needs no copy of this package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
