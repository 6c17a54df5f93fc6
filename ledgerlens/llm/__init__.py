"""Operators of a large-scale training-data pipeline.

One module per operator, each with a general interface; ``queries`` holds the
registered queries (``opN_<name>``) and ``oracle`` their SQL twins.

Functions that run in tasks are shipped by value, so that executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
