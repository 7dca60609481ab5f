"""Regression from chosen input columns to all other measures of a merged table.

Functions that run inside Spark tasks travel with the job by value, so executors need numpy,
pandas and Arrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["areastats"])
