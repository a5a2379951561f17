"""tidewell: Spark-native table mirroring, validation and corpus operators.

Functions that run in Python workers are pickled by value, so executors need
only PySpark, pyarrow and numpy, not a copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
