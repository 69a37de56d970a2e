"""Operators of a training-data pipeline over the text tables."""

import sys

from pyspark import cloudpickle

# executors need not have this package installed: its functions travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .queries import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
