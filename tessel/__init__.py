"""tessel: planar spatial analytics on Spark DataFrames.

Points are ``(id, x, y)`` columns and axis-parallel rectangles ``(id, x1, y1,
x2, y2)``.  Every operator takes and returns DataFrames and runs as Spark
work (grid-keyed equi-joins, built-in aggregates, range partitioning).
"""

from tessel.operators import *  # noqa: F401,F403
from tessel.sources import read_points, read_rectangles, read_window  # noqa: F401

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# functions sent to Python workers travel by value: executors need no copy of this package
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
