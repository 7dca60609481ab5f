"""Operators for preparing training text; a part of its own that nothing else imports."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["areastats"])
