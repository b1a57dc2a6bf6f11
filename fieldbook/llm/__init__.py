"""Operators of a training-data pipeline: dedup, scoring, extraction, scans, mixing.

Nothing outside this package imports it.  Its functions travel to the executors by
value, so that workers need numpy, pyarrow and pyspark but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
