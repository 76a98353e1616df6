"""Operators of a training-data pipeline.

Functions that run in tasks travel with the job, so executors need this package as little as the rest of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
