"""Operators of a large-scale training-data pipeline.

Each module holds one operator; ``catalog`` registers the queries. Functions that
run in Python workers are pickled by value, so executors need no copy of this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
